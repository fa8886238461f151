import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.ledger import MissingPartitionsError
from tessera.schemas import MEASUREMENTS
from tessera.session import scratch_path
from tessera.sources import fetch as S
from tessera.sources import rest_source
from tessera.sources import storage as B

T = dt.datetime
D = dt.date
PC = ["date", "station_number"]
ROW = "formula string, value long, timestamp_measured timestamp, station_number string, date date"


def test_dynamic_overwrite_and_type_drift(spark):
    root = scratch_path(spark, "t-b1")
    day1 = spark.createDataFrame([("no2", 1, T(2024, 1, 1), "s1", D(2024, 1, 1)),
                                  ("no2", 2, T(2024, 1, 2), "s1", D(2024, 1, 2))], ROW)  # all-integer values
    B.write_partitioned(day1, root, "m", PC, MEASUREMENTS)
    again = spark.createDataFrame([("no2", 9, T(2024, 1, 1), "s1", D(2024, 1, 1))], ROW)
    B.write_partitioned(again, root, "m", PC, MEASUREMENTS)
    back = B.read_all_partitions(spark, root, "m", MEASUREMENTS)
    assert dict(back.schema.fields and [(f.name, f.dataType.simpleString()) for f in back.schema.fields])["value"] == "double"
    vals = {str(r.date): r.value for r in back.collect()}
    assert vals == {"2024-01-01": 9.0, "2024-01-02": 2.0}


def test_strict_read_raises_and_lenient_empty(spark):
    root = scratch_path(spark, "t-b4")
    rows = spark.createDataFrame([("no2", 1, T(2024, 1, 1), "s1", D(2024, 1, 1))], ROW)
    B.write_partitioned(rows, root, "m", PC, MEASUREMENTS)
    want = spark.createDataFrame([("2024-01-01", "s1"), ("2024-01-02", "s1")], "date string, station_number string")
    with pytest.raises(MissingPartitionsError):
        B.read_partitions_strict(spark, root, "m", want, MEASUREMENTS, PC)
    req = spark.createDataFrame([("2024-01-05|s9", D(2024, 1, 5), "s9")], "partition_key string, date date, station_number string")
    led = spark.createDataFrame([], "asset_key string, partition_key string, status string, event_time timestamp, event_id long")
    assert B.read_partitions_lenient(spark, root, "m", req, led, MEASUREMENTS, PC).count() == 0
    assert B.read_partitions_lenient(spark, scratch_path(spark, "none"), "m", req, led, MEASUREMENTS, PC).count() == 0
    assert B.missing_on_load(req, led, "m", PC).count() == 1


def test_classify_location(spark):
    df = spark.createDataFrame([("gs://my-bucket/my-path",), ("minio://b/p",), ("/tmp/x",), ("s3a://b/p",)],
                               "location string")
    r = {x.location: x for x in B.classify_location(df).collect()}
    g = r["gs://my-bucket/my-path"]
    assert (g.storage_type, g.bucket, g.prefix, g.is_remote) == ("gcs", "my-bucket", "my-path", True)
    assert r["minio://b/p"].supported is False and r["/tmp/x"].storage_type == "local"
    assert r["s3a://b/p"].is_remote and r["s3a://b/p"].storage_type is None


def _pages(spark, rows):
    return spark.createDataFrame(rows, "request_id string, page int, status int, body string")


def test_page_chains(spark):
    def body(cur, nxt, n=1):
        return json.dumps({"pagination": {"current_page": cur, "next_page": nxt},
                           "data": [{"formula": "no2", "value": 1.0}] * n})
    pages = _pages(spark, [
        ("single", 1, 200, json.dumps({"data": [{"formula": "o3", "value": 2.0}]})),
        ("three", 1, 200, body(1, 2)), ("three", 2, 200, body(2, 3)), ("three", 3, 200, body(3, 3)),
        ("gap", 1, 200, body(1, 2)), ("gap", 3, 200, body(3, 3)),
        ("open", 1, 200, body(1, 2)),
        ("midend", 1, 200, body(1, 1)), ("midend", 2, 200, body(2, 2)),
        ("back", 1, 200, body(1, 2)), ("back", 2, 200, body(2, 1))])
    st = {r.request_id: (r.n_pages, r.complete) for r in S.page_chain_status(pages).collect()}
    assert st == {"single": (1, True), "three": (3, True), "gap": (2, False), "open": (1, False),
                  "midend": (2, False), "back": (2, False)}
    assert S.flatten_pages(pages).filter("request_id = 'three'").count() == 3


def test_error_classes(spark):
    resp = _pages(spark, [("a", 1, 500, None), ("b", 1, 429, None), ("c", 1, 200, "{}"), ("d", 1, 204, '{"data":[]}'),
                         ("e", 1, 200, '{"data":[1'), ("f", 1, 200, None)])
    out = {r.request_id: r.outcome for r in S.classify_responses(resp).collect()}
    assert out == {"a": "dead_letter", "b": "retry", "c": "malformed", "d": "ok", "e": "malformed", "f": "malformed"}


def test_empty_day_page(spark):
    empty = S.empty_page(spark.createDataFrame([("2024-01-01|s1",)], "request_id string"))
    assert S.flatten_pages(empty).count() == 0


def test_fetch_chain_follows_next_page():
    def body(page, then):
        return 200, json.dumps({"pagination": {"current_page": page, "next_page": then}, "data": []})

    assert [p for p, _, _ in rest_source.fetch_chain(lambda p: body(p, min(p + 1, 120_000)))] == list(range(1, 120_001))
    assert [s for _, s, _ in rest_source.fetch_chain(lambda p: (500, None))] == [500]
    assert [x[:2] for x in rest_source.fetch_chain(lambda p: body(p, 1 if p == 2 else p + 1))] == [(1, 200), (2, 200), (1, 508)]
    assert [x[:2] for x in rest_source.fetch_chain(lambda p: (206, body(p, 2)[1]))] == [(1, 206), (2, 206)]


def test_unknown_keys_come_along(spark):
    page = json.dumps({"data": [{"formula": "no2", "value": 1.5, "unit": "ug", "flag": 3}]})
    r = S.flatten_pages(_pages(spark, [("a", 1, 200, page)]), extra=True).first()
    assert (r.formula, r.value, r.extra) == ("no2", 1.5, {"unit": "ug", "flag": "3"})


def test_requests_carry_the_days_bounds(spark):
    k = spark.createDataFrame([("2024-01-31|NL01497",)], "partition_key string")
    r = S.request_rows(S.request_params(k)).first()
    assert json.loads(r.params_json) == {"start": "2024-01-31T00:00:00", "end": "2024-01-31T23:59:59", "station_number": "NL01497"}


def test_request_params_bounds(spark):
    k = spark.createDataFrame([("2024-01-31|NL01497",)], "partition_key string")
    r = S.request_params(k).first()
    assert (r.start, r.end, r.station_number) == ("2024-01-31T00:00:00", "2024-01-31T23:59:59", "NL01497")


def test_station_list_missing_and_duplicates(spark):
    assert S.read_stations(spark, scratch_path(spark, "nofile")).count() == 0
    p = scratch_path(spark, "dup")
    S.write_station_list(spark.createDataFrame([("a", "NL1"), ("b", "NL1")], "location string, number string"), p)
    with pytest.raises(ValueError):
        S.read_stations(spark, p)


def test_write_ledger_metadata(spark):
    root = scratch_path(spark, "t-b11")
    rows = spark.createDataFrame([("no2", 1, T(2024, 1, 1), "s1", D(2024, 1, 1))] * 3
                                 + [("no2", 1, T(2024, 1, 1), "s2", D(2024, 1, 1))], ROW)
    path = B.write_partitioned(rows, root, "m", PC, MEASUREMENTS)
    keys = rows.filter("station_number = 's1'").select(*PC)
    meta = B.output_metadata(spark, path, "m", PC, F.current_timestamp(), MEASUREMENTS, keys).collect()
    assert len(meta) == 1 and meta[0].row_count == 3 and meta[0].partition_key == "2024-01-01|s1"
    assert B.output_metadata(spark, path, "m", PC, F.current_timestamp(), MEASUREMENTS).count() == 2


def test_keys_with_special_characters_and_key_named_files(spark):
    root = scratch_path(spark, "t-b10")
    rows = spark.createDataFrame([("no2", 1, T(2024, 1, 1), "a:b/c%3A", D(2024, 1, 1))], ROW)
    B.write_partitioned(rows, root, "m", PC, MEASUREMENTS)
    key = {("2024-01-01", "a:b/c%3A")}
    assert {tuple(r) for r in B.list_partition_files(spark, root, "m", PC).collect()} == key
    assert B.read_partitions_strict(spark, root, "m", rows.select(*PC), MEASUREMENTS, PC).count() == 1
    st = spark.createDataFrame([("x:y", "L")], "number string, location string")
    B.write_partitioned(st, root, "st", ["number"])
    assert [r.number for r in B.list_partition_files(spark, root, "st", ["number"]).collect()] == ["x:y"]
    named = os.path.join(scratch_path(spark, "t-named"), "k")
    os.makedirs(named)
    for name in ("2024-01-01|NL1.parquet", "2024-01-02|NL2.parquet"):
        with open(os.path.join(named, name), "w") as f:
            f.write("x")
    got = {tuple(r) for r in B.list_partition_files(spark, os.path.dirname(named), "k", PC).collect()}
    assert got == {("2024-01-01", "NL1"), ("2024-01-02", "NL2")}


def test_reads_prune_to_the_keys_folders(spark):
    root = scratch_path(spark, "t-prune")
    rows = spark.createDataFrame([("no2", 1, T(2024, 1, d), f"s{d}", D(2024, 1, d)) for d in range(1, 9)], ROW)
    B.write_partitioned(rows, root, "m", PC, MEASUREMENTS)
    one = rows.filter("station_number = 's3'").select(*PC)
    plan = B.read_partitions_strict(spark, root, "m", one, MEASUREMENTS, PC)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan


def test_every_request_has_a_wave(spark):
    from tessera.plans.flows import request_waves
    keys = spark.range(250).selectExpr("concat('2024-01-0', 1 + id % 3, '|s', id) AS partition_key")
    waves = [r.wave for r in request_waves(S.request_params(keys)).collect()]
    assert sorted(waves) == [0] * 100 + [1] * 100 + [2] * 50


def test_records_land_right_or_become_rejects(spark):
    times = {"2024-01-01T00:00:00+00:00": T(2024, 1, 1), "2024-01-01T02:00:00.5+02:00": T(2024, 1, 1, 0, 0, 0, 500_000),
             "2024-01-01T00:00:00Z": T(2024, 1, 1), "2024-01-01T00:00:00.123456Z": T(2024, 1, 1, 0, 0, 0, 123_456),
             "2024-01-01T00:00:00.120Z": T(2024, 1, 1, 0, 0, 0, 120_000), "2024-01-01 00:00": T(2024, 1, 1), "2024-01-01": T(2024, 1, 1),
             "2024-01-01T00:00:00.123456789Z": T(2024, 1, 1, 0, 0, 0, 123_456), "2023-12-31T19:00:00-0500": T(2024, 1, 1)}
    good = [{"event_id": i, "formula": "no2", "value": 1.5, "timestamp_measured": t} for i, t in enumerate(times)]
    good += [{"event_id": "20", "formula": 7, "value": "2.25"}, {"event_id": None, "value": 3, "unit": "ug", "flag": 3, "odd": {"a": [1]}}, {}]
    bad = [5, None, "text", [1], {"value": "abc"}, {"value": True}, {"event_id": 1.5, "timestamp_measured": 5}, {"timestamp_measured": "12:30"},
           {"timestamp_measured": "yesterday"}, {"event_id": "99999999999999999999"}, {"value": "NaN"}]
    body = json.dumps({"data": [x for pair in zip(good, bad + [0] * len(good)) for x in pair]})
    pages = _pages(spark, [("a", 1, 200, body), ("b", 1, 200, '{"data": {"value": 1}}'), ("c", 1, 200, '{"data": [1'), ("d", 1, 200, None),
                           ("e", 1, 200, "[]"), ("f", 1, 200, '{"data": null}'), ("g", 1, 200, '{"data": []}'), ("h", 1, 200, '{"data": "x"}')])
    rows = S.flatten_pages(pages, extra=True).collect()
    assert len(rows) == len(good) and [r.timestamp_measured for r in rows[:len(times)]] == list(times.values())
    assert [(r.event_id, r.formula, r.value) for r in rows[len(times):]] == [(20, "7", 2.25), (None, None, 3.0), (None, None, None)]
    assert rows[-2].extra == {"unit": "ug", "flag": "3", "odd": '{"a":[1]}'}
    rejects = {r.raw: r.reasons for r in S.rejected_records(pages).collect()}
    assert rejects["5"] == rejects["null"] == rejects['"text"'] == rejects["[1]"] == ["not an object"]
    assert rejects['{"value":"abc"}'] == rejects['{"value":true}'] == rejects['{"value":"NaN"}'] == ["value: not a double"]
    assert rejects['{"event_id":1.5,"timestamp_measured":5}'] == ["event_id: not a bigint", "timestamp_measured: not a timestamp"]
    assert rejects['{"timestamp_measured":"12:30"}'] == rejects['{"timestamp_measured":"yesterday"}'] == ["timestamp_measured: not a timestamp"]
    assert rejects['{"event_id":"99999999999999999999"}'] == ["event_id: not a bigint"]
    shapes = {r.request_id: r.outcome for r in S.classify_responses(pages).collect()}
    assert shapes == dict.fromkeys("bcdefh", "malformed") | {"a": "ok", "g": "ok"}
    assert {r.request_id for r in S.classify_responses(pages, "OBJECT").filter("outcome = 'ok'").collect()} == {"b"}


def test_hosts_that_do_not_answer_are_rows(monkeypatch):
    import urllib.error
    import urllib.request
    transport = rest_source._HttpTransport("http://nowhere.invalid", 0.1)
    for error in (urllib.error.URLError("no such host"), TimeoutError(), ConnectionResetError()):
        def broken(*_, **__):
            raise error
        monkeypatch.setattr(urllib.request, "urlopen", broken)
        assert transport.get("measurements", {}, 1) == (rest_source.NETWORK_STATUS, None)


def test_network_errors_are_retried(spark):
    assert S.classify_responses(_pages(spark, [("a", 1, rest_source.NETWORK_STATUS, None)])).first().outcome == "retry"


def test_saved_pages_nobody_asked_for_are_not_dealt(spark):
    path = scratch_path(spark, "t-asked")
    _pages(spark, [(f"r{i}", 1, 200, '{"data":[]}') for i in range(100)]).write.parquet(path)
    asked = spark.createDataFrame([("r7", "m", None)], "request_id string, endpoint string, params_json string")
    out = rest_source.fetch(asked, {"transport": "replay", "replay": path})
    assert [r.request_id for r in out.collect()] == ["r7"]
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


def test_bodies_are_checked_without_naming_their_schema(spark):
    from tessera.sources import fetch as S
    record = '{"formula":"no2","value":"1.5","timestamp_measured":"2024-01-01T01:00:00Z","unit":{"a":[1]}}'
    bodies = ['{"data":[%s,17,null,{"value":true,"timestamp_measured":[1]}]}' % record, '{"data":{"a":1}}', '{"data":null}', '[1]', '{"data":"x"}', "{", None]
    pages = spark.createDataFrame([(str(i), 1, 200, b) for i, b in enumerate(bodies)], "request_id string, page int, status int, body string")

    def outcomes(shape):
        return [r.outcome for r in S.classify_responses(pages, shape).orderBy("request_id").collect()]

    assert outcomes("ARRAY") == ["ok", *["malformed"] * 6] and outcomes("OBJECT") == ["malformed", "ok", *["malformed"] * 5]
    checked = S.checked_records(pages)
    got = {r.place: r for r in checked.collect()}
    assert [got[i].reasons for i in range(4)] == [[], ["not an object"], ["not an object"],
                                                  ["value: not a double", "timestamp_measured: not a timestamp"]]
    assert got[0].value == 1.5 and got[0].extra == {"unit": '{"a":[1]}'} and got[0].raw is None and got[1].raw == "17"
    for frame in (S.classify_responses(pages), checked):  # naming the schema of every body was most of the work
        assert "schema" not in frame._jdf.queryExecution().optimizedPlan().toString().lower()


def test_chains_from_links_as_from_bodies(spark):
    from tessera.sources import fetch as S
    def body(cur, nxt):
        return '{"pagination":{"current_page":%s,"next_page":%s},"data":[]}' % (cur, nxt)
    rows = [("a", 1, body(1, 2)), ("a", 2, body(2, 2)), ("b", 1, body(1, 2)), ("c", 1, '{"data":[]}'), ("d", 1, body(1, 3)), ("d", 2, body(2, 1)),
            ("d", 3, body(3, 3)), ("e", 1, None)]
    pages = spark.createDataFrame(rows, "request_id string, page int, body string")
    links = S.page_links(pages)
    assert "body" not in links.columns and links.count() == len(rows)
    assert sorted(S.page_chain_status(links).collect()) == sorted(S.page_chain_status(pages).collect())
    assert {r.request_id: r.complete for r in S.page_chain_status(links).collect()} == {"a": True, "b": False, "c": True, "d": False, "e": True}
