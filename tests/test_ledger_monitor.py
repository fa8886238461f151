import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions.timefn import ts_lit
from tessera.operators import ledger as L
from tessera.operators import monitor as M

T = dt.datetime
LEDGER = "asset_key string, partition_key string, status string, event_time timestamp, event_id long"
RUNS = ("run_id string, job_name string, status string, asset_selection array<string>, location string, "
        "tags map<string,string>, update_time timestamp, end_time timestamp")


def test_missing_partitions_keeps_order_free_set(spark):
    grid = spark.createDataFrame([(f"2020-01-0{i}|NL01497",) for i in (1, 2, 3)], "partition_key string")
    led = spark.createDataFrame([("a", "2020-01-01|NL01497", "MATERIALIZED", T(2020, 1, 2), 1)], LEDGER)
    out = sorted(r.partition_key for r in L.missing_partitions(grid, led, "a").collect())
    assert out == ["2020-01-02|NL01497", "2020-01-03|NL01497"]


def test_repeated_events_and_latest_status(spark):
    led = spark.createDataFrame([
        ("a", "k1", "MATERIALIZED", T(2024, 1, 1), 1), ("a", "k1", "MATERIALIZED", T(2024, 1, 2), 2),
        ("a", "k2", "MATERIALIZED", T(2024, 1, 1), 3), ("a", "k2", "FAILED", T(2024, 1, 2), 4),
        ("a", "k3", "FAILED", T(2024, 1, 1), 6), ("a", "k3", "MATERIALIZED", T(2024, 1, 1), 5)], LEDGER)
    mat = {r.partition_key: r.n_events for r in L.materialized_partitions(led, "a").collect()}
    assert mat == {"k1": 2, "k2": 1, "k3": 1}
    latest = {r.partition_key: r.status for r in L.latest_status(led).collect()}
    assert latest == {"k1": "MATERIALIZED", "k2": "FAILED", "k3": "FAILED"}   # tie -> larger id


def test_unknown_asset_raises(spark):
    led = spark.createDataFrame([("a", "k", "MATERIALIZED", T(2024, 1, 1), 1)], LEDGER)
    req = spark.createDataFrame([("my_asset",)], "asset_key string")
    with pytest.raises(L.UnknownAssetError, match="Asset 'my_asset' not found"):
        L.check_assets_exist(req, led)
    L.check_assets_exist(req, led, skip_checks=True)


def test_report_twice_adds_nothing(spark):
    led = spark.createDataFrame([], LEDGER)
    keys = spark.createDataFrame([("k1",), ("k2",)], "partition_key string")
    new = L.report_materialized(L.reconcile_storage(keys, led, "a"), "a", ts_lit("2024-01-01 00:00:00"))
    assert new.count() == 2
    led2 = led.unionByName(new)
    assert L.reconcile_storage(keys, led2, "a").count() == 0


def _runs(spark, rows):
    return spark.createDataFrame(rows, RUNS)


def test_trigger_and_labels(spark):
    t = T(2024, 1, 1, 0, 0, 1, 500000)
    runs = _runs(spark, [
        ("1", "j", "SUCCESS", ["x"], "loc", {"dagster/backfill": "bf", "dagster/schedule_name": "s"}, t, t),
        ("2", "j", "FAILURE", [], "loc", {"dagster/schedule_name": "s", "dagster/partition": "p"}, t, t),
        ("3", "j", "SUCCESS", ["x"], "loc", {"dagster/auto_materialize": ""}, t, t),
        ("4", "j", "SUCCESS", ["x"], "loc", {"dagster/auto_materialize": "true"}, t, t)])
    lab = {r.run_id: r for r in M.run_labels(runs, "dev").collect()}
    assert (lab["1"].trigger_type, lab["1"].trigger_name) == ("backfill", "bf")
    assert (lab["2"].trigger_type, lab["2"].trigger_name) == ("schedule", "s")
    assert (lab["3"].trigger_type, lab["3"].trigger_name) == ("manual", "N/A")
    assert lab["4"].trigger_type == "auto_materialize"
    assert lab["2"].asset_name is None and lab["2"].partition_key == "p" and lab["1"].partition_key == "N/A"
    pts = {r.run_id: r for r in M.success_points(M.run_labels(runs, "dev")).collect()}
    assert (pts["1"].seconds, pts["1"].nanos, pts["1"].value, pts["2"].value) == (1704067201, 500000000, 1, 0)


def test_cursor_unchanged_without_rows(spark):
    empty = _runs(spark, [])
    r = M.advance_cursor(empty, ts_lit("2024-01-01 00:00:00")).first()
    assert r.cursor == T(2024, 1, 1) and r.n_runs == 0


def test_job_statistics_eight_runs_one_failure(spark):
    keys = [f"2021-01-0{d}|{s}" for d in (1, 2, 3, 4) for s in ("NL01345", "NL05432")]
    rows = []
    for i, k in enumerate(keys):
        st = "FAILURE" if k == "2021-01-02|NL01345" else "SUCCESS"
        rows.append((str(i), "j", st, ["x"], "l", {"dagster/backfill": "test", "dagster/partition": k},
                     T(2021, 1, 5), T(2021, 1, 5)))
    runs = _runs(spark, rows)
    expected = spark.createDataFrame([("test", k) for k in keys], "trigger_name string, partition_key string")
    s = M.job_statistics(expected, runs).first()
    assert (s.total, s.successful, s.failed, s.done, s.unfinished) == (8, 7, 1, 8, 0)
    upstream = spark.createDataFrame([(k,) for k in keys], "partition_key string")
    got = M.runs_by_trigger(runs, ("SUCCESS", "FAILURE"), upstream, backfill_name="test")
    assert got.filter("status = 'SUCCESS'").count() == 7 and got.filter("status = 'FAILURE'").count() == 1
    bf = M.backfill_partitions(runs.filter(F.col("run_id") != "7"), "test", upstream)
    assert bf.count() == 7


def test_run_key_dedupe_and_counter(spark):
    t = T(2024, 1, 1)
    runs = _runs(spark, [("1", "j", "SUCCESS", ["x"], "l", {"dagster/run_key": "done"}, t, t)])
    req = spark.createDataFrame([("done",), ("new",), ("new",), (None,), (None,)], "run_key string")
    assert sorted(str(r.run_key) for r in M.run_key_dedupe(req, runs).collect()) == ["None", "None", "new"]
    ticks = spark.createDataFrame([("k",)] * 15 + [("m",)] * 14, "run_key string")
    c = {r.run_key: r.skip for r in M.unfinished_counter(ticks).collect()}
    assert c == {"k": True, "m": False}


def test_downstream_ready_failures_count_as_finished(spark):
    t = T(2024, 1, 1)
    runs = _runs(spark, [
        ("1", "j", "SUCCESS", ["x"], "l", {"dagster/partition": "2024-01-01|a"}, t, t),
        ("2", "j", "FAILURE", ["x"], "l", {"dagster/partition": "2024-01-01|b"}, t, t),
        ("3", "j", "STARTED", ["x"], "l", {"dagster/partition": "2024-01-02|a"}, t, t)])
    expected = spark.createDataFrame([(k.split("|")[0], k) for k in (
        "2024-01-01|a", "2024-01-01|b", "2024-01-02|a", "2024-01-03|a")], "daily_key string, partition_key string")
    r = {x.daily_key: x.ready for x in M.downstream_ready(expected, runs).collect()}
    assert r == {"2024-01-01": True, "2024-01-02": False, "2024-01-03": False}


def test_a_run_in_flight_is_the_latest(spark):
    tags = {"dagster/partition": "2024-01-01|a", "dagster/backfill": "b"}
    runs = _runs(spark, [("1", "j", "SUCCESS", ["x"], "l", tags, T(2024, 1, 1, 1), T(2024, 1, 1, 1)),
                         ("2", "j", "STARTED", ["x"], "l", tags, T(2024, 1, 1, 2), None)])
    expected = spark.createDataFrame([("2024-01-01", "2024-01-01|a")], "daily_key string, partition_key string")
    assert [(r.n_unfinished, r.ready) for r in M.downstream_ready(expected, runs).collect()] == [(1, False)]
    want = spark.createDataFrame([("b", "2024-01-01|a")], "trigger_name string, partition_key string")
    assert [(r.done, r.unfinished) for r in M.job_statistics(want, runs).collect()] == [(0, 1)]


def test_first_request_of_a_run_key_stays(spark):
    runs = _runs(spark, [])
    req = spark.createDataFrame([("k", 3, "c", {"a": "1"}), ("k", 1, "b", {"a": "2"}), ("k", 1, "a", {"a": "3"}), (None, 9, "z", None)],
                                "run_key string, at int, name string, tags map<string,string>").repartition(3)
    assert sorted((str(r.run_key), r.at, r.name) for r in M.run_key_dedupe(req, runs).collect()) == [("None", 9, "z"), ("k", 1, "a")]
    by_name = M.run_key_dedupe(req.select("name", "run_key", "at"), runs, ["name"])
    assert by_name.columns == ["name", "run_key", "at"] and {r.name for r in by_name.collect()} == {"a", "z"}
