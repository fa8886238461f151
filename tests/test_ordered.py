"""Ranks, windows and grids where one key, moment or request holds everything."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import freshness as FR
from tessera.operators import ordered
from tessera.operators import pacing as PC
from tessera.operators import partitions as P


def busy_calls(spark, n):
    """One bucket and one 5-minute slice; a third of the calls share one microsecond."""
    ts = "CASE WHEN id % 3 = 0 THEN timestamp '2024-01-01 00:01:00' ELSE timestamp_micros(1704067200000000 + (id * 7919) % 299999999) END AS ts"
    return spark.range(n).selectExpr("'only' AS bucket", "id AS call_id", ts)


def test_a_busy_slice_is_dealt_over_tasks(spark):
    calls = busy_calls(spark, 300_000)
    sizes = [r["count"] for r in ordered._dealt(calls, ["bucket"], ["ts", "call_id"]).groupBy("_range").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 300_000 / 3
    want = calls.selectExpr("call_id", "row_number() OVER (PARTITION BY bucket ORDER BY ts, call_id) AS rank")
    got = PC.rate_wave_plan(calls).select("call_id", F.col("rank").cast("int").alias("rank"))
    assert got.exceptAll(want).count() == 0 and got.count() == 300_000
    got = PC.rate_window_audit(calls).selectExpr("unix_micros(ts) AS us", "calls_in_window AS n").toPandas()
    us = np.sort(got["us"].to_numpy())
    want = np.searchsorted(us, got["us"], "right") - np.searchsorted(us, got["us"] - 300_000_000, "right")
    assert len(got) == 300_000 and (got["n"].to_numpy() == want).all()


def test_windows_with_nulls_ties_and_gaps(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(b, i, None if i % 7 == 0 else t + dt.timedelta(seconds=(i * 37) % 900 // 10 * 10)) for i, b in enumerate(["a", "b", None] * 60)]
    calls = spark.createDataFrame(rows, "bucket string, call_id long, ts timestamp")
    want = {r.call_id: r.n for r in calls.selectExpr(
        "call_id", "count(*) OVER (PARTITION BY bucket ORDER BY unix_micros(ts) RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS n").collect()}
    assert {r.call_id: r.calls_in_window for r in PC.rate_window_audit(calls).collect()} == want
    assert PC.rate_window_audit(calls.limit(0)).count() == PC.rate_wave_plan(calls.limit(0)).count() == 0


def grid(spark, rows, **kw):
    req = spark.createDataFrame(rows, "name string, s date, e date, stations array<string>")
    out = P.partition_grid(req, {"daily": ("s", "e")}, {"stations": "stations"}, **kw)
    assert out.columns == ["name", "s", "e", "stations", "daily"] or set(out.columns) == {"name", "s", "e", "stations", "daily"}
    return out


def test_large_requests_are_dealt_in_stretches_of_days(spark):
    rows = [("big", dt.date(2020, 1, 1), dt.date(2024, 12, 31), ["a", "b", "a"]), ("one", dt.date(2024, 1, 1), dt.date(2024, 1, 1), ["x", "x"]),
            ("none", dt.date(2024, 1, 2), dt.date(2024, 1, 1), ["x"]), ("null", None, dt.date(2024, 1, 1), ["x"]), ("empty", dt.date(2024, 1, 1), dt.date(2024, 1, 2), [])]
    want = {tuple(r) for r in grid(spark, rows).select("name", "daily", "stations").collect()}
    assert len(want) == 2 * 1827 + 1
    for least in (0, 10):
        dealt = grid(spark, rows, row_partitions=least)
        got = [tuple(r) for r in dealt.select("name", "daily", "stations").collect()]
        assert len(got) == len(want) and set(got) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = grid(spark, rows, row_partitions=10).filter("name = 'big'").select(F.spark_partition_id().alias("t")).distinct().count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks >= 4


def test_days_and_ranges(spark):
    days = [("a", d) for d in (1, 2, 3, 5, 9, 10, 10)] + [("b", 31), (None, 4), (None, 5), ("c", None)]
    df = spark.createDataFrame([(k, None if d is None else dt.date(2024, 1, d)) for k, d in days], "k string, day date").repartition(3)
    got = {(r.k, r.first_day.day, r.last_day.day, r.n_days) for r in P.day_ranges(df, ["k"], "day").collect()}
    assert got == {("a", 1, 3, 3), ("a", 5, 5, 1), ("a", 9, 10, 2), ("b", 31, 31, 1), (None, 4, 5, 2)}
    back = {(r.k, r.day.day) for r in P.expand_ranges(P.day_ranges(df, ["k"], "day"), "day").collect()}
    assert back == {(k, d) for k, d in days if d is not None}


def test_versions_are_merged_and_adjusted(spark):
    def rows(*r):
        return spark.createDataFrame(r or [], "p string, v double") if r else spark.createDataFrame([], "p string, v double")

    def versions(*r):
        return FR.data_version(rows(*r), ["p"], ["v"])

    state = versions(("a", 1.0), ("b", 2.0), ("b", 3.0), (None, 4.0), ("d", 5.0))
    run = versions(("a", 1.0), ("b", 2.0), ("c", 9.0), (None, 4.5))
    merged = FR.merge_versions(state, run, ["p"])
    assert {(r.p, r.seen, r.new, r.changed) for r in merged.collect()} == {
        ("a", True, False, False), ("b", True, False, True), ("c", True, True, True), (None, True, False, True), ("d", False, False, False)}
    nxt = {r.p: r.data_version for r in merged.collect()}
    assert nxt == {r.p: r.data_version for r in versions(("a", 1.0), ("b", 2.0), ("c", 9.0), (None, 4.5), ("d", 5.0)).collect()}
    moved = FR.adjust_versions(state, rows(("b", 7.0), ("e", 8.0)), rows(("b", 2.0), ("d", 5.0)), ["p"], ["v"])
    assert {r.p: r.data_version for r in moved.collect()} == {r.p: r.data_version for r in versions(
        ("a", 1.0), ("b", 3.0), ("b", 7.0), (None, 4.0), ("e", 8.0)).collect()}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "+- Window" not in plan and plan.count("Join FullOuter") == plan.count("Join ") == 1
