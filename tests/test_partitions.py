import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.timefn import ts_lit
from tessera.operators import partitions as P

D = dt.date


def _req(spark, rows):
    return spark.createDataFrame(rows, "name string, start_date date, end_date date, stations array<string>, "
                                       "policy string, asset_key string, file_type string")


def test_grid_two_stations_three_days(spark):
    req = _req(spark, [("t", D(2024, 1, 31), D(2024, 2, 2), ["NL01497", "NL01912"], "all", None, "parquet")])
    g = P.partition_grid(req, {"daily": ("start_date", "end_date")}, {"stations": "stations"})
    assert g.count() == 6
    assert {str(r.daily) for r in g.collect()} == {"2024-01-31", "2024-02-01", "2024-02-02"}


def test_key_is_ordered_by_dimension_name(spark):
    df = spark.createDataFrame([("NL01497", "2024-01-31")], "stations string, daily string")
    out = P.with_partition_key(df, ["stations", "daily"]).first()
    assert out.partition_key == "2024-01-31|NL01497"


def test_decode_round_trip(spark):
    df = spark.createDataFrame([("2024-01-31|NL01497",)], "partition_key string")
    r = P.split_partition_key(df, "partition_key", ["daily", "stations"]).first()
    assert (r.daily, r.stations) == ("2024-01-31", "NL01497")


def test_days_inclusive_edges(spark):
    req = _req(spark, [("eq", D(2024, 1, 1), D(2024, 1, 1), [], "all", None, "parquet"),
                       ("down", D(2024, 1, 3), D(2024, 1, 1), [], "all", None, "parquet")])
    out = {r.name: 0 for r in req.collect()}
    for r in P.days_inclusive(req).collect():
        out[r.name] += 1
    assert out == {"eq": 1, "down": 0}


def test_days_closed_end_exclusive_and_zone(spark):
    req = spark.createDataFrame([(D(2021, 1, 1), D(2021, 1, 5)), (D(2021, 1, 1), D(2021, 1, 3))],
                                "start_date date, end_date date")
    out = P.days_closed(req, ts_lit("2030-01-01 00:00:00"), end="end_date")
    counts = out.groupBy("end_date").count().orderBy("end_date").collect()
    assert [c["count"] for c in counts] == [2, 4]
    # 23:30 UTC on 2024-03-30 is 00:30 on 03-31 in Amsterdam: 03-30 is closed.
    one = spark.createDataFrame([(D(2024, 3, 29),)], "start_date date")
    days = [str(r.date) for r in P.days_closed(one, ts_lit("2024-03-30 23:30:00")).collect()]
    assert days == ["2024-03-29", "2024-03-30"]


def test_day_to_multi_and_back(spark):
    days = [D(2021, 1, d) for d in range(1, 5)]
    keys = [(d, f"{d}|{s}") for d in days for s in ("NL01345", "NL05432")]
    multi = spark.createDataFrame(keys, "date date, partition_key string")
    daily = spark.createDataFrame([(d,) for d in days], "date date")
    m = P.map_day_to_multi(daily, multi)
    got = {}
    for r in m.collect():
        got.setdefault(r.daily_key, []).append(r.upstream_key)
    assert len(got) == 4
    assert sorted(got["2021-01-01"]) == ["2021-01-01|NL01345", "2021-01-01|NL05432"]
    back = {r.partition_key: r.daily_key for r in P.map_multi_to_day(multi).collect()}
    assert len(back) == 8 and back["2021-01-01|NL01345"] == "2021-01-01"


def test_validation_rules(spark):
    req = _req(spark, [
        ("ok", D(2024, 1, 1), D(2024, 1, 1), ["a"], "missing", "x", "parquet"),
        ("late", D(2024, 1, 3), D(2024, 1, 1), ["a"], "all", None, "parquet"),
        ("pol", D(2024, 1, 1), D(2024, 1, 2), ["a"], "sometimes", "x", "parquet"),
        ("noasset", D(2024, 1, 1), D(2024, 1, 2), ["a"], "missing", None, "parquet"),
        ("nulls", None, D(2024, 1, 2), ["a"], None, None, None),
        ("csv", D(2024, 1, 1), D(2024, 1, 2), ["a"], "all", None, "csv")])
    v = {r.name: (r.valid, list(r.errors)) for r in P.validate_backfills(req).collect()}
    assert v["ok"] == (True, [])
    assert not v["late"][0] and not v["pol"][0] and not v["noasset"][0] and not v["csv"][0]
    assert v["nulls"][1] == ["start_date or end_date missing", "policy missing", "type missing"]
    assert v["noasset"][1] == ["policy missing needs asset_key"]


def test_dimension_by_days_uses_no_join(spark):
    st = spark.createDataFrame([("a",), ("b",)], "station string")
    g = P.dimension_by_days(st, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"))
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert g.count() == 6 and "Join" not in plan and "Exchange" not in plan
