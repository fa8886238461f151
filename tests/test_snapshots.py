"""Versions of a partitioned table: writers at the same time, crashes, buckets, clean-up."""

import datetime as dt
import glob
import threading

import pytest
from pyspark.sql import types as T

from tessera.schemas import MEASUREMENTS
from tessera.session import scratch_path
from tessera.sources import snapshots
from tessera.sources import storage as B

PC = ["date", "station_number"]
D = dt.date
ROW = "formula string, value double, station_number string, date date"


def rows(spark, station, n, days=(1,), value=1.0):
    return spark.createDataFrame([("no2", value, station, None if d is None else D(2024, 1, d)) for d in days for _ in range(n)], ROW)


def state(spark, root, version=None):
    out = {}
    for r in B.read_all_partitions(spark, root, "m", MEASUREMENTS, version).collect():
        key = (r.date and r.date.day, r.station_number)
        out.setdefault(key, []).append(r.value)
    return {k: (len(v), set(v)) for k, v in out.items()}


def test_two_writers_of_one_day_lose_nothing(spark, monkeypatch):
    root = scratch_path(spark, "t-two")
    B.write_partitioned(rows(spark, "c", 10, days=(1, 2)), root, "m", PC, MEASUREMENTS)
    commit, seen = snapshots.commit, []

    def interleaved(session, path, snap):
        if not seen:  # between the first writer's files and its manifest another writer comes and goes
            seen.append(state(spark, root))
            B.write_partitioned(rows(spark, "b", 2000), root, "m", PC, MEASUREMENTS)
            seen.append(state(spark, root))
        return commit(session, path, snap)

    monkeypatch.setattr(snapshots, "commit", interleaved)
    B.write_partitioned(rows(spark, "a", 2000, days=(1, 3)), root, "m", PC, MEASUREMENTS)
    base = {(1, "c"): (10, {1.0}), (2, "c"): (10, {1.0})}
    assert seen == [base, base | {(1, "b"): (2000, {1.0})}]  # no mix: all of a version or nothing
    assert state(spark, root) == base | {(1, "b"): (2000, {1.0}), (1, "a"): (2000, {1.0}), (3, "a"): (2000, {1.0})}
    assert [state(spark, root, v) for v in (1, 2)] == seen
    assert {(r.date, r.station_number) for r in B.list_partition_files(spark, root, "m", PC).collect()} == {
        ("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-01", "c"), ("2024-01-02", "c"), ("2024-01-03", "a")}


def test_of_two_writers_of_one_partition_the_later_stays(spark, monkeypatch):
    root = scratch_path(spark, "t-same")
    commit, seen = snapshots.commit, []

    def interleaved(session, path, snap):
        if not seen:
            seen.append(1)
            B.write_partitioned(rows(spark, "a", 3, value=1.0).unionByName(rows(spark, "b", 4)), root, "m", PC, MEASUREMENTS)
        return commit(session, path, snap)

    monkeypatch.setattr(snapshots, "commit", interleaved)
    B.write_partitioned(rows(spark, "a", 5, value=2.0), root, "m", PC, MEASUREMENTS)
    assert state(spark, root) == {(1, "a"): (5, {2.0}), (1, "b"): (4, {1.0})}


def test_writers_in_threads(spark):
    root = scratch_path(spark, "t-threads")
    failed = []

    def write(i):
        try:
            B.write_partitioned(rows(spark, f"s{i}", 50 + i, days=(1, 2)), root, "m", PC, MEASUREMENTS)
        except Exception as e:  # noqa: BLE001 - reported below
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert state(spark, root) == {(d, f"s{i}"): (50 + i, {1.0}) for i in range(4) for d in (1, 2)}
    assert snapshots.snapshot(spark, f"{root}/m").version == 4


def test_a_writer_that_dies_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "t-crash")
    B.write_partitioned(rows(spark, "a", 5), root, "m", PC, MEASUREMENTS)

    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", dies)
        with pytest.raises(RuntimeError, match="gone"):
            B.write_partitioned(rows(spark, "a", 7, value=9.0), root, "m", PC, MEASUREMENTS)
    assert state(spark, root) == {(1, "a"): (5, {1.0})}
    assert B.list_partition_files(spark, root, "m", PC).count() == 1
    B.write_partitioned(rows(spark, "b", 2), root, "m", PC, MEASUREMENTS)
    assert state(spark, root) == {(1, "a"): (5, {1.0}), (1, "b"): (2, {1.0})}
    # the dead writer's files and, once forgotten, version 1 go; the newest version stays
    assert snapshots.vacuum(spark, f"{root}/m", keep_versions=1) == 0
    assert snapshots.vacuum(spark, f"{root}/m", keep_versions=1, older_than_s=-5) == 2
    assert state(spark, root) == {(1, "a"): (5, {1.0}), (1, "b"): (2, {1.0})}
    with pytest.raises(ValueError, match="no version 1"):
        B.read_all_partitions(spark, root, "m", MEASUREMENTS, 1)


def test_a_version_number_is_given_once(spark):
    path = scratch_path(spark, "t-once")
    snap = snapshots.Snapshot(1, {"date=2024-01-01": "write=wx"}, ("date",))
    assert snapshots.commit(spark, path, snap) and not snapshots.commit(spark, path, snapshots.Snapshot(1, {}, ("date",)))
    assert snapshots.snapshot(spark, path) == snap
    assert not [n for n in glob.glob(f"{path}/_manifests/.*") if not n.endswith(".crc")]


def test_null_days_and_emptied_days(spark):
    root = scratch_path(spark, "t-null")
    B.write_partitioned(rows(spark, "a", 2, days=(None, 1)).unionByName(rows(spark, None, 3)), root, "m", PC, MEASUREMENTS)
    B.write_partitioned(rows(spark, "b", 4, days=(None,)), root, "m", PC, MEASUREMENTS)
    assert state(spark, root) == {(None, "a"): (2, {1.0}), (1, "a"): (2, {1.0}), (1, None): (3, {1.0}), (None, "b"): (4, {1.0})}
    keys = spark.createDataFrame([(None, "a"), (D(2024, 1, 1), None)], "date date, station_number string")
    got = B.read_partitions_strict(spark, root, "m", keys, MEASUREMENTS, PC)
    assert sorted(r.station_number or "" for r in got.collect()) == ["", "", "", "a", "a"]
    empty = rows(spark, "a", 0)
    keys = spark.createDataFrame([(D(2024, 1, 1), "a"), (D(2024, 1, 1), None), (D(2024, 1, 9), "x")], "date date, station_number string")
    B.write_partitioned(empty, root, "m", PC, MEASUREMENTS, keys=keys)
    assert state(spark, root) == {(None, "a"): (2, {1.0}), (None, "b"): (4, {1.0})}


def test_buckets_do_not_depend_on_the_number_of_values(spark):
    root = scratch_path(spark, "t-buckets")
    schema = T.StructType.fromDDL("number string, location string")
    many = spark.range(500).selectExpr("concat('N/', id) AS number", "'old' AS location")
    B.write_partitioned(many, root, "st", ["number"], schema, buckets=4)
    B.write_partitioned(many.filter("number IN ('N/3', 'N/4')").selectExpr("number", "'new' AS location"), root, "st", ["number"], schema)
    back = B.read_all_partitions(spark, root, "st", schema)
    assert back.count() == 500 and {r.number for r in back.filter("location = 'new'").collect()} == {"N/3", "N/4"}
    snap = snapshots.snapshot(spark, f"{root}/st")
    assert set(snap.folders) == {f"bucket={i}" for i in range(4)} and snap.buckets == 4
    one = spark.createDataFrame([("N/3",)], "number string")
    got = B.read_partitions_strict(spark, root, "st", one, schema, ["number"])
    assert [tuple(r) for r in got.collect()] == [("N/3", "new")] and len({f.split("/bucket=")[1][0] for f in got.inputFiles()}) == 1


def test_tables_of_others_are_read_but_not_written(spark):
    root = scratch_path(spark, "t-plain")
    rows(spark, "a", 2, days=(1, 2)).write.partitionBy("date").parquet(f"{root}/m")
    assert B.read_all_partitions(spark, root, "m", MEASUREMENTS).count() == 4
    keys = spark.createDataFrame([("2024-01-02", "a")], "date string, station_number string")
    assert B.read_partitions_strict(spark, root, "m", keys, MEASUREMENTS, PC).count() == 2
    assert B.list_partition_files(spark, root, "m", PC).count() == 2
    with pytest.raises(ValueError, match="without versions"):
        B.write_partitioned(rows(spark, "a", 2), root, "m", PC, MEASUREMENTS)
