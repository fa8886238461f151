import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.functions.timefn import ts_lit
from tessera.operators import freshness as FR
from tessera.operators import pacing as PC

T = dt.datetime


def _calls(spark, rows):
    return spark.createDataFrame(rows, "bucket string, call_id long, ts timestamp")


def test_window_audit_matches_brute_force(spark):
    rnd = random.Random(7)
    base = T(2024, 1, 1)
    rows = []
    for i in range(600):
        b = "hot" if i % 3 else "cold"
        rows.append((b, i, base + dt.timedelta(seconds=rnd.randint(0, 3600))))
    rows.append(("hot", 10_000, base + dt.timedelta(seconds=300)))      # exactly one window after t0
    rows.append(("hot", 10_001, base))
    got = {r.call_id: r.calls_in_window for r in PC.rate_window_audit(_calls(spark, rows)).collect()}
    for b, cid, ts in rows:
        want = sum(1 for b2, _, t2 in rows if b2 == b and ts - dt.timedelta(seconds=300) < t2 <= ts)
        assert got[cid] == want, cid


def test_wave_plan_matches_global_rank(spark):
    rnd = random.Random(3)
    base = T(2024, 1, 1)
    rows = [("b", i, base + dt.timedelta(minutes=rnd.randint(0, 600))) for i in range(450)]
    out = {r.call_id: (r.rank, r.wave, r.gives_up) for r in PC.rate_wave_plan(_calls(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[2], r[1]))
    for rank, (_, cid, _) in enumerate(order, 1):
        assert out[cid][0] == rank and out[cid][1] == (rank - 1) // 100
        assert out[cid][2] == ((rank - 1) // 100 >= 1)


def test_data_version_is_order_insensitive(spark):
    rows = [("p", "no2", 1.5, T(2024, 1, 1)), ("p", "o3", 2.25, T(2024, 1, 2))]
    s = "part string, formula string, value double, ts timestamp"
    a = FR.data_version(spark.createDataFrame(rows, s), ["part"], ["formula", "value", "ts"]).first()
    b = FR.data_version(spark.createDataFrame(rows[::-1], s).repartition(2), ["part"], ["formula", "value", "ts"]).first()
    c = FR.data_version(spark.createDataFrame(rows[:1], s), ["part"], ["formula", "value", "ts"]).first()
    assert a.data_version == b.data_version != c.data_version


def test_changed_partitions(spark):
    v = spark.createDataFrame([("k", 1, "v1"), ("k", 2, "v1"), ("k", 3, "v2"), ("n", 3, "x")],
                              "k string, run int, data_version string")
    r = {(x.k, x.run): (x.new, x.changed) for x in FR.changed_partitions(v, ["k"]).collect()}
    assert r[("k", 2)] == (False, False) and r[("k", 3)] == (False, True) and r[("n", 3)] == (True, True)


def test_retry_schedule(spark):
    rows = [("k", T(2024, 1, 1, 0, i), str(i), False) for i in range(4)] + [("p", T(2024, 1, 1), "x", True)]
    f = spark.createDataFrame(rows, "run_key string, failed_at timestamp, attempt_id string, permanent boolean")
    out = {(r.run_key, r.attempt): r for r in FR.retry_schedule(f).collect()}
    assert [out[("k", n)].action for n in (1, 2, 3, 4)] == ["retry", "retry", "retry", "give_up"]
    assert out[("p", 1)].action == "dead_letter"
    a3 = out[("k", 3)]
    assert a3.latest_us - a3.earliest_us == 120_000_000           # base 120 s, ±50 %


def test_cron_ticks_in_amsterdam(spark):
    from tessera.functions.timefn import daily_cron_tick, monthly_cron_tick
    r = spark.range(1).select(daily_cron_tick(ts_lit("2024-01-30 23:59:59"), 3).alias("d"),
                              monthly_cron_tick(ts_lit("2024-02-01 00:30:00")).alias("m")).first()
    assert r.d == T(2024, 1, 30, 2) and r.m == T(2024, 1, 31, 23)
    _ = F


def test_cron_ticks_on_dst_days(spark):
    from tessera.functions.timefn import daily_cron_tick, last_closed_day
    r = spark.range(1).select(
        daily_cron_tick(ts_lit("2024-03-31 05:00:00"), 3).alias("spring"),      # 03:00 CEST = 01:00 UTC
        daily_cron_tick(ts_lit("2024-10-27 05:00:00"), 3).alias("autumn"),      # 03:00 CET = 02:00 UTC
        daily_cron_tick(ts_lit("2024-03-31 00:30:00"), 3).alias("before"),      # still the 30th's tick
        last_closed_day(ts_lit("2024-10-26 22:30:00")).alias("closed")).first()  # 00:30 local on the 27th
    assert r.spring == T(2024, 3, 31, 1) and r.autumn == T(2024, 10, 27, 2)
    assert r.before == T(2024, 3, 30, 2)
    assert str(r.closed) == "2024-10-26"


def test_no_row_with_a_null_is_lost_by_the_rank(spark):
    t = T(2024, 1, 1)
    out = PC.rate_wave_plan(_calls(spark, [("b", 1, t), (None, 2, t), ("b", 3, None), (None, 4, None)])).collect()
    assert {r.call_id: r.rank for r in out} == {1: 2, 2: 2, 3: 1, 4: 1}
    f = spark.createDataFrame([("k", None, "1", False), (None, t, "2", False)],
                              "run_key string, failed_at timestamp, attempt_id string, permanent boolean")
    assert FR.retry_schedule(f).count() == 2
    v = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", None, "c")], "k string, run int, data_version string")
    got = {(r.k, r.run): (r.new, r.changed) for r in FR.changed_partitions(v, ["k"]).collect()}
    assert got == {(None, 1): (True, True), (None, 2): (False, True), ("k", None): (True, True)}


def test_fingerprint_sees_every_change_of_a_double(spark):
    values = [0.0, 1.0, 1.0 + 2 ** -52, 1e-7, 1e13, 1e13 + 2 ** -9, 1e300, 1e-300, -1.0, -1e-7, 5e-324, 1.7e308,
              float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "p string, v double")
    got = {r.data_version for r in FR.data_version(rows, ["p"], ["v"]).collect()}
    assert len(got) == len(values)


def test_due_rules_see_their_own_asset_only(spark):
    now = ts_lit("2024-01-10 12:00:00")
    parts = spark.createDataFrame([("2024-01-09|s", dt.date(2024, 1, 9))], "partition_key string, date date")
    led = spark.createDataFrame([("other", "2024-01-09|s", "MATERIALIZED", T(2024, 1, 10, 6))],
                                "asset_key string, partition_key string, status string, event_time timestamp")
    assert FR.cron_due_latest(parts, led, "mine", now).first().due and not FR.cron_due_latest(parts, led, "other", now).first().due
    assert FR.cron_due_all(parts, led, "mine", now).first().due and FR.due_missing(parts, led, "mine").count() == 1
    child = spark.createDataFrame([("d", T(2024, 1, 1))], "child_key string, child_time timestamp")
    ups = spark.createDataFrame([("d", "p1", T(2024, 1, 2)), ("d", "x", T(2024, 1, 2))],
                                "child_key string, parent_asset string, parent_time timestamp")
    assert not FR.parents_updated_gate(child, ups, ["p1", "p2"]).first().run
