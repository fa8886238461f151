"""Check queries for freshness, change detection and pacing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tags import tag
from tessera.functions.timefn import ts_lit
from tessera.operators import freshness as FR
from tessera.operators import pacing as PC
from tessera.plans.q_ledger import GRID_SQL, measurement_grid
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import TAG_RUN_KEY
from tessera.sources import testviews as V

F3_NOW = "2024-01-30 23:59:59"
F4_NOW = "2024-01-15 12:00:00"
F8_NOW = "2024-02-01 00:30:00"

# A double as exact integers, as freshness.exact_text writes it.
_K = "CASE WHEN abs(value) >= pow(2, 100) OR (abs(value) > 0 AND abs(value) < pow(2, -80)) THEN floor(log2(abs(value)) / 100) ELSE 0 END"
_S = f"(value * pow(2, -100 * ({_K})))"
_A = f"floor({_S} * pow(2, -40))"
_R1 = f"({_S} - {_A} * pow(2, 40))"
_B = f"floor({_R1} * pow(2, 20))"
_R2 = f"({_R1} - {_B} * pow(2, -20))"
_C = f"floor({_R2} * pow(2, 80))"
_D = f"floor(({_R2} - {_C} * pow(2, -80)) * pow(2, 140))"
_EXACT = " || ':' || ".join(f"CAST(CAST({x} AS BIGINT) AS VARCHAR)" for x in (_K, _A, _B, _C, _D))
_HASH_TEXT = f"concat_ws(chr(31), coalesce(formula, '\\N'), coalesce({_EXACT}, '\\N'), coalesce(CAST(epoch_us(timestamp_measured) AS VARCHAR), '\\N'))"
VERSION_SQL = f"""
SELECT date, station_number, count(*) AS n_rows,
       CAST(sum(CAST(('0x' || substr(md5({_HASH_TEXT}), 1, 8)) AS BIGINT)) AS BIGINT) AS h1,
       CAST(sum(CAST(('0x' || substr(md5({_HASH_TEXT}), 9, 8)) AS BIGINT)) AS BIGINT) AS h2
FROM src GROUP BY date, station_number"""


VERSION_COLS = ["formula", "value", "timestamp_measured"]


def _versions(df: DataFrame) -> DataFrame:
    return FR.data_version(df, ["date", "station_number"], VERSION_COLS).withColumn("date", F.col("date").cast("string"))


@register("data_version", with_views(f"""
SELECT CAST(date AS VARCHAR) AS date, station_number, n_rows, h1, h2,
       CAST(n_rows AS VARCHAR) || '-' || CAST(h1 AS VARCHAR) || '-' || CAST(h2 AS VARCHAR) AS data_version
FROM ({VERSION_SQL.replace('FROM src', 'FROM v_measurements')}) v""", "v_measurements"))
def q_data_version(spark, d):
    v = _versions(V.measurements(spark, d))
    return v.withColumn("date", F.col("date").cast("string"))


@register("changed_partitions", with_views(f"""
SELECT CAST(date AS VARCHAR) AS date, station_number, run,
       row_number() OVER w = 1 AS new,
       (lag(h1) OVER w IS DISTINCT FROM h1 OR lag(h2) OVER w IS DISTINCT FROM h2
        OR lag(n_rows) OVER w IS DISTINCT FROM n_rows) AS changed
FROM (SELECT 1 AS run, * FROM ({VERSION_SQL.replace('FROM src', "FROM v_measurements WHERE formula <> 'error'")}) a
      UNION ALL
      SELECT 2 AS run, * FROM ({VERSION_SQL.replace('FROM src', 'FROM v_measurements')}) b) v
WINDOW w AS (PARTITION BY date, station_number ORDER BY run)""", "v_measurements"))
def q_changed_partitions(spark, d):
    """Run 1 fetched everything but the ``error`` measurements, run 2 all; each is merged into the state before."""
    m = V.measurements(spark, d)
    keys = ["date", "station_number"]
    first = FR.merge_versions(_versions(m.filter(F.lit(False))), _versions(m.filter(F.col("formula") != "error")), keys)
    second = FR.merge_versions(first.select(*keys, *FR.VERSION_PARTS, "data_version"), _versions(m), keys)
    out = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))).filter("seen")
    return out.select(F.col("date").cast("string").alias("date"), "station_number", "run", "new", "changed")


@register("version_history", with_views(f"""
SELECT CAST(date AS VARCHAR) AS date, station_number, run, row_number() OVER w = 1 AS new,
       (lag(h1) OVER w IS DISTINCT FROM h1 OR lag(h2) OVER w IS DISTINCT FROM h2
        OR lag(n_rows) OVER w IS DISTINCT FROM n_rows) AS changed
FROM (SELECT 1 AS run, * FROM ({VERSION_SQL.replace('FROM src', "FROM v_measurements WHERE formula <> 'error'")}) a
      UNION ALL
      SELECT 2 AS run, * FROM ({VERSION_SQL.replace('FROM src', 'FROM v_measurements')}) b
      UNION ALL
      SELECT 3 AS run, * FROM ({VERSION_SQL.replace('FROM src', "FROM v_measurements WHERE event_id % 3 > 0")}) c) v
WINDOW w AS (PARTITION BY date, station_number ORDER BY run)""", "v_measurements"))
def q_version_history(spark, d):
    """Run 1 fetched everything but the ``error`` measurements, run 2 all, and then a third went again (run 3), whose
    versions come from those of run 2 by taking off the rows that went."""
    m = V.measurements(spark, d)
    keys = ["date", "station_number"]
    second = _versions(m)
    went = m.filter(F.col("event_id") % 3 == 0).withColumn("date", F.col("date").cast("string"))
    third = FR.adjust_versions(second, went.filter(F.lit(False)), went, keys, VERSION_COLS)
    every = [v.withColumn("run", F.lit(i)) for i, v in ((1, _versions(m.filter(F.col("formula") != "error"))), (2, second), (3, third))]
    out = FR.changed_partitions(every[0].unionByName(every[1]).unionByName(every[2].select(every[0].columns)), keys)
    return out.select("date", "station_number", "run", "new", "changed")


def _tz_tick_sql(now: str, kind: str) -> str:
    local = f"timezone('Europe/Amsterdam', TIMESTAMPTZ '{now}+00')"
    if kind == "daily3":
        t = f"(date_trunc('day', {local}) + INTERVAL 3 HOUR)"
        t = f"(CASE WHEN {t} <= {local} THEN {t} ELSE {t} - INTERVAL 1 DAY END)"
    else:
        t = f"date_trunc('month', {local})"
    return f"timezone('UTC', timezone('Europe/Amsterdam', CAST({t} AS TIMESTAMP)))"


@register("cron_due_latest", with_views(f"""
SELECT g.partition_key, CAST(l.last_materialized AS VARCHAR) AS last_materialized,
       CAST({_tz_tick_sql(F3_NOW, 'daily3')} AS VARCHAR) AS tick,
       l.last_materialized IS NULL OR l.last_materialized < {_tz_tick_sql(F3_NOW, 'daily3')} AS due
FROM grid g
LEFT JOIN (SELECT partition_key, max(event_time) AS last_materialized FROM v_meas_ledger_many
           WHERE asset_key = 'air_quality_data' AND status = 'MATERIALIZED' GROUP BY 1) l ON l.partition_key = g.partition_key
WHERE g.date = CAST(timezone('Europe/Amsterdam', TIMESTAMPTZ '{F3_NOW}+00') AS DATE) - 1""",
                                        "v_stations", "v_meas_ledger_many", extra={"grid": GRID_SQL}))
def q_cron_due_latest(spark, d):
    out = FR.cron_due_latest(measurement_grid(spark, d), V.many_assets(V.measurement_ledger(spark, d)),
                             V.MEASUREMENT_ASSET, ts_lit(F3_NOW))
    return out.select("partition_key", F.col("last_materialized").cast("string").alias("last_materialized"),
                      F.col("tick").cast("string").alias("tick"), "due")


@register("cron_due_all", with_views(f"""
SELECT g.partition_key, l.last_materialized IS NULL OR l.last_materialized < {_tz_tick_sql(F4_NOW, 'month')} AS due
FROM grid g
LEFT JOIN (SELECT partition_key, max(event_time) AS last_materialized FROM v_meas_ledger_rr_many
           WHERE asset_key = 'air_quality_data' AND status = 'MATERIALIZED' AND event_time <= TIMESTAMP '{F4_NOW}' GROUP BY 1) l
       ON l.partition_key = g.partition_key
WHERE g.date <= CAST(timezone('Europe/Amsterdam', TIMESTAMPTZ '{F4_NOW}+00') AS DATE) - 1""",
                                     "v_stations", "v_meas_ledger_rr_many", extra={"grid": GRID_SQL}))
def q_cron_due_all(spark, d):
    now = ts_lit(F4_NOW)
    grid = measurement_grid(spark, d).filter(F.col("date") <= F.date_sub(F.to_date(F.from_utc_timestamp(now, "Europe/Amsterdam")), 1))
    ledger = V.many_assets(V.measurement_ledger(spark, d, failed_reruns=True)).filter(F.col("event_time") <= now)
    return FR.cron_due_all(grid, ledger, V.MEASUREMENT_ASSET, now).select("partition_key", "due")


@register("due_missing", with_views("""
SELECT CAST(date AS VARCHAR) AS date, station_number FROM grid
WHERE partition_key NOT IN (SELECT partition_key FROM v_meas_ledger_rr_many WHERE asset_key = 'air_quality_data')""",
                                    "v_stations", "v_meas_ledger_rr_many", extra={"grid": GRID_SQL}))
def q_due_missing(spark, d):
    out = FR.due_missing(measurement_grid(spark, d), V.many_assets(V.measurement_ledger(spark, d, failed_reruns=True)),
                         V.MEASUREMENT_ASSET)
    return out.select(F.col("date").cast("string").alias("date"), "station_number")


def _children(spark: SparkSession, d: str, hour: int, minute: int) -> DataFrame:
    days = V.measurements(spark, d).select("date").distinct()
    t = F.to_timestamp(F.concat(F.col("date").cast("string"), F.lit(f" {hour:02d}:{minute:02d}:00")))
    return days.select(F.col("date").cast("string").alias("child_key"), t.alias("child_time"))


@register("due_parent_updated", with_views("""
SELECT CAST(date AS VARCHAR) AS child_key, CAST(max(event_time) AS VARCHAR) AS newest_parent,
       max(event_time) > CAST(date AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 30 MINUTE AS due
FROM v_meas_ledger GROUP BY date""", "v_meas_ledger"))
def q_due_parent_updated(spark, d):
    """Daily bronze partitions were materialized at 23:30 of their day;
    landing partitions updated after that make the day due again."""
    parents = V.measurement_ledger(spark, d).select(
        F.col("date").cast("string").alias("child_key"), F.col("event_time").alias("parent_time"))
    out = FR.due_parent_updated(_children(spark, d, 23, 30), parents)
    return out.select("child_key", F.col("newest_parent").cast("string").alias("newest_parent"), "due")


@register("parents_updated_gate", with_views("""
SELECT CAST(c.date AS VARCHAR) AS child_key, coalesce(n_updated, 0) AS n_updated, coalesce(n_updated, 0) = 2 AS run
FROM (SELECT DISTINCT date FROM v_measurements) c
LEFT JOIN (SELECT date, count(*) AS n_updated FROM (
             SELECT date, asset, max(timestamp_measured) AS t FROM (
               SELECT date, 'air_quality_data' AS asset, timestamp_measured FROM v_measurements
               UNION ALL
               SELECT date, 'air_quality_alerts', timestamp_measured FROM v_measurements WHERE formula = 'error') u
             GROUP BY 1, 2) a
           WHERE t > CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR GROUP BY date) p ON p.date = c.date""",
                                             "v_measurements"))
def q_parents_updated_gate(spark, d):
    """Two parent assets per day: the landing data and its ``error`` alerts.
    The daily child (materialized at noon) runs only if both have updates
    after noon; updates of an asset that is no parent don't count."""
    m = V.measurements(spark, d)
    ups = (m.select(F.col("date").cast("string").alias("child_key"), F.lit("air_quality_data").alias("parent_asset"),
                    F.col("timestamp_measured").alias("parent_time"))
           .unionByName(m.filter(F.col("formula") == "error").select(
               F.col("date").cast("string").alias("child_key"), F.lit("air_quality_alerts").alias("parent_asset"),
               F.col("timestamp_measured").alias("parent_time")))
           .unionByName(m.select(F.col("date").cast("string").alias("child_key"), F.lit("station_names").alias("parent_asset"),
                                 F.col("timestamp_measured").alias("parent_time"))))
    out = FR.parents_updated_gate(_children(spark, d, 12, 0), ups, ["air_quality_data", "air_quality_alerts"])
    return out.select("child_key", "n_updated", "run")


@register("freshness_lag", with_views(f"""
SELECT station_number,
       greatest(CAST(floor((epoch_us({_tz_tick_sql(F8_NOW, 'month')}) - epoch_us(max(event_time))) / 60000000) AS BIGINT), 0) AS lag_minutes,
       greatest(CAST(floor((epoch_us({_tz_tick_sql(F8_NOW, 'month')}) - epoch_us(max(event_time))) / 60000000) AS BIGINT), 0) > 10 AS violation
FROM v_meas_ledger WHERE status = 'MATERIALIZED' GROUP BY station_number""", "v_meas_ledger"))
def q_freshness_lag(spark, d):
    latest = (V.measurement_ledger(spark, d).filter(F.col("status") == "MATERIALIZED")
              .groupBy("station_number").agg(F.max("event_time").alias("last_materialized")))
    return FR.freshness_lag(latest, ts_lit(F8_NOW)).select("station_number", "lag_minutes", "violation")


@register("retry_schedule", with_views("""
SELECT run_id, run_key, attempt, action,
       CASE WHEN action = 'retry' THEN end_us + (30000000 * CAST(pow(2, attempt - 1) AS BIGINT)) // 2 END AS earliest_us,
       CASE WHEN action = 'retry' THEN end_us + (30000000 * CAST(pow(2, attempt - 1) AS BIGINT)) * 3 // 2 END AS latest_us
FROM (SELECT run_id, run_key, end_us, attempt,
             CASE WHEN CAST(run_id AS BIGINT) % 13 = 0 THEN 'dead_letter'
                  WHEN attempt <= 3 THEN 'retry' ELSE 'give_up' END AS action
      FROM (SELECT *, row_number() OVER (PARTITION BY run_key ORDER BY end_us, run_id) AS attempt
            FROM v_runs WHERE status = 'FAILURE' AND run_key IS NOT NULL) a) b""", "v_runs"))
def q_retry_schedule(spark, d):
    """Failed runs are the attempts; every 13th run id stands for an HTTP 500
    (permanent) failure."""
    runs = V.runs(spark, d).filter(F.col("status") == "FAILURE")
    fails = (runs.select("run_id", tag("tags", TAG_RUN_KEY).alias("run_key"),
                         F.col("end_time").alias("failed_at"), F.col("run_id").alias("attempt_id"),
                         (F.col("run_id").cast("long") % 13 == 0).alias("permanent"))
             .filter(F.col("run_key").isNotNull()))
    out = FR.retry_schedule(fails)
    return out.select("run_id", "run_key", "attempt", "action", "earliest_us", "latest_us")


@register("rate_window_audit", with_views("""
SELECT call_id, bucket,
       count(*) OVER (PARTITION BY bucket ORDER BY epoch_us(ts) RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS calls_in_window,
       count(*) OVER (PARTITION BY bucket ORDER BY epoch_us(ts) RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) > 100 AS over_limit
FROM v_calls""", "v_calls"))
def q_rate_window_audit(spark, d):
    return PC.rate_window_audit(V.calls(spark, d)).select("call_id", "bucket", "calls_in_window", "over_limit")


@register("rate_wave_plan", with_views("""
SELECT call_id, bucket, rank, (rank - 1) // 100 AS wave, ((rank - 1) // 100) * 300 AS wait_s,
       ((rank - 1) // 100) * 300 > 270 AS gives_up
FROM (SELECT call_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY ts, call_id) AS rank FROM v_calls) r""",
                                       "v_calls"))
def q_rate_wave_plan(spark, d):
    return PC.rate_wave_plan(V.calls(spark, d)).select("call_id", "bucket", "rank", "wave", "wait_s", "gives_up")
