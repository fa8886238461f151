import datetime as dt
import json

import pytest

from tessera.functions.timefn import ts_lit
from tessera.plans import flows as G
from tessera.schemas import MEASUREMENTS
from tessera.session import scratch_path
from tessera.sources import fetch as S
from tessera.sources import storage as B

PAGE = "request_id string, page int, status int, body string"


def _page(cur, nxt, recs):
    return json.dumps({"pagination": {"current_page": cur, "next_page": nxt}, "data": recs})


def _rec(i, v):
    return {"unit": f"u{i}", "event_id": i, "formula": "no2", "value": v, "timestamp_measured": "2024-01-01T01:00:00.000000Z"}


def _land(spark, root, pages, keys, when, name):
    spark.createDataFrame(pages, PAGE).write.parquet(f"{root}/{name}")
    asked = spark.createDataFrame([(k,) for k in keys], "partition_key string")
    out = G.landing_measurements(spark, asked, f"{root}/lake", f"{root}/ledger", ts_lit(when),
                                 {"transport": "replay", "replay": f"{root}/{name}"}).collect()
    rows = B.read_all_partitions(spark, f"{root}/lake", G.LANDING, MEASUREMENTS).collect()
    landed = {}
    for r in rows:
        assert set(r.extra) == {"unit"}
        k = f"{r.date}|{r.station_number}"
        landed[k] = landed.get(k, 0) + 1
    return {r.partition_key: r for r in out}, landed


def test_only_requests_fetched_in_full_land(spark):
    root = scratch_path(spark, "t-g1")
    keys = [f"2024-01-0{1 + i // 5}|NL0000{i}" for i in range(9)]
    pages = [
        (keys[0], 1, 206, _page(1, 2, [_rec(1, 1.5), _rec(2, 2.5)])), (keys[0], 2, 200, _page(2, 2, [_rec(3, 3.0)])),
        (keys[1], 1, 200, json.dumps({"data": []})),
        (keys[2], 1, 500, None),
        (keys[3], 1, 429, None),
        (keys[4], 1, 200, _page(1, 2, [_rec(4, 1.0)])), (keys[4], 2, 429, None),
        (keys[5], 1, 200, _page(1, 2, [_rec(5, 1.0)])), (keys[5], 2, 500, None),
        (keys[6], 1, 200, _page(1, 2, [_rec(6, 1.0)])), (keys[6], 2, 200, _page(2, 1, [_rec(7, 1.0)])),
        (keys[7], 1, 200, _page(1, 1, [_rec(8, 1.0)])[:50]),
        (keys[8], 1, 200, _page(1, 2, [_rec(9, 1.0)])),  # page 2 was never saved
        ("someone else", 1, 200, _page(1, 1, [_rec(10, 1.0)]))]
    ev, landed = _land(spark, root, pages, keys, "2024-01-02 00:00:00", "r1")
    assert {k: r.status for k, r in ev.items()} == {
        keys[0]: "MATERIALIZED", keys[1]: "MATERIALIZED", keys[2]: "FAILED", keys[5]: "FAILED", keys[7]: "FAILED"}
    assert (ev[keys[0]].row_count, ev[keys[1]].row_count, ev[keys[1]].data_version) == (3, 0, "0-0-0")
    assert landed == {keys[0]: 3}
    assert ev[keys[0]].data_version != "0-0-0"

    # The same run again adds no event; a rerun with an empty page empties the partition, and with it the day.
    again, landed = _land(spark, root, pages, keys, "2024-01-02 00:00:00", "r2")
    assert landed == {keys[0]: 3} and G.read_ledger(spark, f"{root}/ledger").count() == 5
    ev, landed = _land(spark, root, [(keys[0], 1, 200, json.dumps({"data": []}))], keys[:1], "2024-01-03 00:00:00", "r3")
    assert [(r.row_count, r.data_version) for r in ev.values()] == [(0, "0-0-0")] and landed == {}
    ev, landed = _land(spark, root, [(k, 1, 200, _page(1, 1, [_rec(1, 1.0)])) for k in keys], keys, "2024-01-04 00:00:00", "r4")
    assert landed == {k: 1 for k in keys}
    ev, landed = _land(spark, root, [(keys[1], 1, 200, json.dumps({"data": []}))], keys[1:2], "2024-01-05 00:00:00", "r5")
    assert landed == {k: 1 for k in keys if k != keys[1]}  # the day's other stations are carried over


def test_a_retry_at_the_same_time_overrules(spark):
    from tessera.operators.ledger import latest_status
    root, key, now = scratch_path(spark, "t-g1-retry"), "2024-01-01|a", "2024-01-02 00:00:00"
    good = (key, 1, 200, _page(1, 1, [_rec(1, 1.0)]))

    def latest():
        return [(r.status, r.event_time) for r in latest_status(G.read_ledger(spark, f"{root}/ledger")).collect()]

    t = dt.datetime(2024, 1, 2)
    _land(spark, root, [(key, 1, 500, None)], [key], now, "r1")
    assert latest() == [("FAILED", t)]
    _, landed = _land(spark, root, [good], [key], now, "r2")
    assert landed == {key: 1} and latest() == [("MATERIALIZED", t)]
    _land(spark, root, [good], [key], now, "r3")  # nothing new
    assert G.read_ledger(spark, f"{root}/ledger").count() == 2
    _land(spark, root, [(key, 1, 500, None)], [key], now, "r4")
    assert latest() == [("FAILED", t)]
    _land(spark, root, [good], [key], now, "r5")  # as r2, but after r4
    assert latest() == [("MATERIALIZED", t)] and G.read_ledger(spark, f"{root}/ledger").count() == 4


def test_odd_bodies_empty_no_partition_and_rejects_are_kept(spark):
    root, keys = scratch_path(spark, "t-g1-odd"), ["2024-01-01|a", "2024-01-01|b", "2024-01-01|c"]
    _, landed = _land(spark, root, [(k, 1, 200, _page(1, 1, [_rec(1, 1.0)])) for k in keys], keys, "2024-01-02 00:00:00", "r1")
    assert landed == dict.fromkeys(keys, 1)
    odd = [(keys[0], 1, 200, json.dumps({"data": {"formula": "no2"}})),
           (keys[1], 1, 200, _page(1, 1, [_rec(1, "2.5"), 17, _rec(2, "abc"), _rec(3, 3.0) | {"timestamp_measured": "2024-01-01T00:00:00+00:00"}])),
           (keys[2], 1, 599, None)]
    ev, landed = _land(spark, root, odd, keys, "2024-01-03 00:00:00", "r2")
    assert {k: (r.status, r.row_count) for k, r in ev.items()} == {keys[0]: ("FAILED", 0), keys[1]: ("MATERIALIZED", 2)}
    assert landed == {keys[0]: 1, keys[1]: 2, keys[2]: 1}
    rows = B.read_all_partitions(spark, f"{root}/lake", G.LANDING, MEASUREMENTS).filter("station_number = 'b'").collect()
    assert {(r.value, r.timestamp_measured) for r in rows} == {(2.5, dt.datetime(2024, 1, 1, 1)), (3.0, dt.datetime(2024, 1, 1))}
    assert {(r.request_id, r.place, tuple(r.reasons)) for r in G.read_rejects(spark, f"{root}/lake").collect()} == {
        (keys[1], 1, ("not an object",)), (keys[1], 2, ("value: not a double",))}


def test_reports_return_their_own_assets_events(spark):
    root = scratch_path(spark, "t-g6")
    rows = spark.createDataFrame([("no2", 1.0, dt.datetime(2024, 1, 1, 1), "a", dt.date(2024, 1, 1))],
                                 "formula string, value double, timestamp_measured timestamp, station_number string, date date")
    B.write_partitioned(rows, f"{root}/lake", G.LANDING, G.PCOLS, MEASUREMENTS)
    other = spark.createDataFrame([("other", "k", "MATERIALIZED", dt.datetime(2024, 1, 5), 7)],
                                  "asset_key string, partition_key string, status string, event_time timestamp, event_id long")
    G.append_ledger(other, f"{root}/ledger")
    out = G.report_storage(spark, f"{root}/lake", G.LANDING, f"{root}/ledger", ts_lit("2024-01-05 00:00:00"), G.PCOLS, skip_checks=True)
    assert [(r.asset_key, r.partition_key) for r in out.collect()] == [(G.LANDING, "2024-01-01|a")]


def test_a_request_without_saved_page_raises(spark):
    root = scratch_path(spark, "t-none")
    with pytest.raises(Exception, match="no saved page"):
        _land(spark, root, [("2024-01-01|a", 1, 200, json.dumps({"data": []}))], ["2024-01-01|b"], "2024-01-02 00:00:00", "r")


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_stations_do_not_depend_on_parallelism(spark, tasks):
    root = scratch_path(spark, f"t-g3-{tasks}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        names = [f"NL{i:03d}" for i in range(40)]
        S.write_station_list(spark.createDataFrame([(f"L {n}", n) for n in names], "location string, number string"), f"{root}/list")
        saved = [(f"stations/{n}", 1, 200, json.dumps({"data": {"number": n, "location": f"L {n}"}})) for n in names]
        spark.createDataFrame(saved, PAGE).repartition(tasks).write.parquet(f"{root}/replay")
        opts = {"transport": "replay", "replay": f"{root}/replay"}
        assert {r.number for r in G.landing_stations(spark, f"{root}/list", f"{root}/lake", opts).collect()} == set(names)
        spark.createDataFrame([*saved[1:], (saved[0][0], 1, 429, None)], PAGE).write.parquet(f"{root}/broken")
        with pytest.raises(RuntimeError, match="NL000"):
            G.landing_stations(spark, f"{root}/list", f"{root}/lake2", {"transport": "replay", "replay": f"{root}/broken"})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_failed_rerun_and_emptied_day_in_bronze(spark):
    root = scratch_path(spark, "t-g2")
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([("no2", 1.0, dt.datetime(2024, 1, 1, 1), "a", day)],
                                 "formula string, value double, timestamp_measured timestamp, station_number string, date date")
    B.write_partitioned(rows, f"{root}/lake", G.LANDING, G.PCOLS, MEASUREMENTS)
    schema = "asset_key string, partition_key string, status string, event_time timestamp, event_id long"
    ok = [(G.LANDING, "2024-01-01|a", "MATERIALIZED", dt.datetime(2024, 1, 2), 1)]
    daily = spark.createDataFrame([(day,)], "date date")
    upstream = spark.createDataFrame([(day, "2024-01-01|a")], "date date, partition_key string")

    def bronze(events):
        r = G.bronze_daily_measurements(spark, f"{root}/lake", spark.createDataFrame(events, schema), daily, upstream, f"{root}/b").first()
        return r.n_rows, r.n_stations, r.n_missing

    assert bronze(ok) == (1, 1, 0)
    assert bronze([*ok, (G.LANDING, "2024-01-01|a", "FAILED", dt.datetime(2024, 1, 3), 2)]) == (0, 0, 1)


def test_backfill_missing_rejects_and_submits(spark):
    req = spark.createDataFrame(
        [("ok", "j", "r", "missing", "a", dt.date(2024, 1, 1), dt.date(2024, 1, 2), ["s1"], "parquet"),
         ("ghost", "j", "r", "missing", "nowhere", dt.date(2024, 1, 1), dt.date(2024, 1, 1), ["s1"], "parquet"),
         ("bad", "j", "r", "all", None, dt.date(2024, 1, 3), dt.date(2024, 1, 1), ["s1"], "parquet")],
        "name string, job_name string, repository_name string, policy string, asset_key string, "
        "start_date date, end_date date, stations array<string>, file_type string")
    led = spark.createDataFrame([("a", "2024-01-01|s1", "MATERIALIZED", dt.datetime(2024, 1, 2), 1)],
                                "asset_key string, partition_key string, status string, event_time timestamp, event_id long")
    out = {(r.name, r.decision, r.partition_key) for r in G.backfill_missing(req, led).collect()}
    assert out == {("ok", "submit", "2024-01-02|s1"), ("bad", "reject", None), ("ghost", "reject", None)}
