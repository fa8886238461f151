"""Check queries for the ledger and backfill operators L1–L9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tags import tag
from tessera.functions.timefn import ts_lit
from tessera.operators import ledger as L
from tessera.operators.partitions import dimension_by_days
from tessera.plans.flows import append_ledger
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import (TAG_BACKFILL, TAG_JOB_NAME, TAG_PARTITION,
                             TAG_PARTITION_DIM_PREFIX, TAG_TRIGGERED_BY,
                             STATUS_MATERIALIZED)
from tessera.session import scratch_path
from tessera.sources import storage as B
from tessera.sources import testviews as V
from tessera.sources.ledger_store import compact, read_condensed

# The ledger as it was known at this instant; partitions written later
# are in storage but not yet reported.
LEDGER_AS_OF = "2024-01-25 00:00:00"
REPORT_NOW = "2024-01-31 00:00:00"
# The state of a ledger on disk is brought up to date at these instants.
STATE_CUTS = ("2024-01-15 00:00:00", "2024-01-25 00:00:00")


def measurement_grid(spark: SparkSession, d: str) -> DataFrame:
    """All (date, station) partitions the measurement asset should have:
    every known station times every day from the first to the last day."""
    m = V.measurements(spark, d)
    bounds = m.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    st = V.stations(spark, d).select(F.col("number").alias("station_number"))
    g = dimension_by_days(st, bounds)
    return g.withColumn("partition_key", F.concat_ws("|", F.col("date").cast("string"), "station_number"))


GRID_SQL = """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) || '|' || number AS partition_key,
       CAST(d AS DATE) AS date, number AS station_number
FROM v_stations,
     (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM v_measurements) days"""


@register("materialized_partitions", with_views("""
SELECT asset_key, partition_key, count(*) AS n_events
FROM v_ledger
WHERE status = 'MATERIALIZED' AND asset_key = 'air_quality_data'
  AND partition_key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY asset_key, partition_key""", "v_ledger"))
def q_materialized_partitions(spark, d):
    keys = (V.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").cast("string").alias("partition_key")))
    return L.materialized_partitions(V.ledger(spark, d), "air_quality_data", keys=keys)


@register("latest_status", with_views("""
SELECT asset_key, partition_key, arg_max(status, (event_time, event_id)) AS status,
       CAST(max(event_time) AS VARCHAR) AS event_time
FROM v_ledger GROUP BY asset_key, partition_key""", "v_ledger"))
def q_latest_status(spark, d):
    out = L.latest_status(V.ledger(spark, d))
    return out.withColumn("event_time", F.col("event_time").cast("string"))


def _kept_ledger(spark: SparkSession, events: DataFrame) -> str:
    """The events written as three appends by time, with the state brought up to date after each of the first two."""
    path = f"{scratch_path(spark, 'ledger')}/ledger"
    early, late = F.col("event_time") < ts_lit(STATE_CUTS[0]), F.col("event_time") >= ts_lit(STATE_CUTS[1])
    for n, part in enumerate((early | F.col("event_time").isNull(), ~early & ~late, late)):
        append_ledger(events.filter(part), path)
        if n < 2:
            compact(spark, path)
    return path


@register("ledger_state", with_views("""
SELECT asset_key, partition_key, arg_max(status, (event_time, event_id)) AS status,
       CAST(max(event_time) AS VARCHAR) AS event_time,
       CAST(max(CASE WHEN status = 'MATERIALIZED' THEN event_time END) AS VARCHAR) AS last_materialized
FROM v_ledger GROUP BY asset_key, partition_key""", "v_ledger"))
def q_ledger_state(spark, d):
    """Latest status and latest materialization from the condensed state and the append after it."""
    events = read_condensed(spark, _kept_ledger(spark, V.ledger(spark, d)))
    done = F.max(F.when(F.col("status") == STATUS_MATERIALIZED, F.col("event_time")))
    last = events.groupBy("asset_key", "partition_key").agg(done.cast("string").alias("last_materialized"))
    out = L.latest_status(events).withColumn("event_time", F.col("event_time").cast("string"))
    return out.join(last, ["asset_key", "partition_key"])


@register("unknown_assets", with_views("""
SELECT DISTINCT asset_name AS asset_key FROM v_runs
WHERE asset_name IS NOT NULL AND asset_name NOT IN (SELECT asset_key FROM v_ledger)""", "v_runs", "v_ledger"))
def q_unknown_assets(spark, d):
    requested = V.runs(spark, d).select(F.get("asset_selection", 0).alias("asset_key"))
    return L.unknown_assets(requested, V.ledger(spark, d))


@register("missing_partitions", with_views("""
SELECT CAST(g.date AS VARCHAR) AS date, g.station_number
FROM grid g
WHERE g.partition_key NOT IN (SELECT partition_key FROM v_meas_ledger WHERE status = 'MATERIALIZED')""",
                                           "v_stations", "v_meas_ledger", extra={"grid": GRID_SQL}))
def q_missing_partitions(spark, d):
    out = L.missing_partitions(measurement_grid(spark, d), V.measurement_ledger(spark, d), "air_quality_data")
    return out.select(F.col("date").cast("string").alias("date"), "station_number")


PLAN_SQL = """
SELECT b.name, b.policy, b.job_name, b.repository_name, g.daily, g.stations,
       g.daily || '|' || g.stations AS partition_key
FROM v_backfill_checked b
JOIN (SELECT name, CAST(CAST(d AS DATE) AS VARCHAR) AS daily, station AS stations
      FROM (SELECT name, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d,
                   stations FROM v_backfills) t, unnest(t.stations) u(station)) g ON g.name = b.name
WHERE b.errors = ''
  AND (b.policy = 'all' OR (g.daily || '|' || g.stations) NOT IN
       (SELECT partition_key FROM v_meas_ledger l WHERE l.status = 'MATERIALIZED' AND l.asset_key = b.asset_key))"""


@register("backfill_plan", with_views("""
SELECT name, policy, daily, stations, partition_key FROM plan""", "v_backfill_checked", "v_meas_ledger",
                                      extra={"plan": PLAN_SQL}))
def q_backfill_plan(spark, d):
    plan = L.backfill_plan(V.backfills(spark, d), V.measurement_ledger(spark, d))
    return plan.select("name", "policy", "daily", "stations", "partition_key")


@register("backfill_plan_kept", with_views("""
SELECT name, partition_key, daily, stations FROM plan""", "v_backfill_checked", "v_meas_ledger", extra={"plan": PLAN_SQL}))
def q_backfill_plan_kept(spark, d):
    """L5 over a ledger on disk: from its condensed state and the append after it instead of its history."""
    path = _kept_ledger(spark, V.measurement_ledger(spark, d))
    plan = L.backfill_plan(V.backfills(spark, d), read_condensed(spark, path))
    return plan.select("name", "partition_key", "daily", "stations")


@register("backfill_ranges", with_views("""
SELECT name, stations, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS n_days
FROM (SELECT name, stations, day, day - CAST(row_number() OVER (PARTITION BY name, stations ORDER BY day) AS INTEGER) AS stretch
      FROM (SELECT DISTINCT name, stations, CAST(daily AS DATE) AS day FROM plan) p) s
GROUP BY name, stations, stretch""", "v_backfill_checked", "v_meas_ledger", extra={"plan": PLAN_SQL}))
def q_backfill_ranges(spark, d):
    """The plan as stretches of consecutive days per request and station."""
    out = L.backfill_ranges(L.backfill_plan(V.backfills(spark, d), V.measurement_ledger(spark, d)))
    return out.select("name", "stations", F.col("first_day").cast("string").alias("first_day"),
                      F.col("last_day").cast("string").alias("last_day"), "n_days")


def _write_measurements(spark: SparkSession, d: str) -> str:
    from tessera.plans.q_storage import shared_landing
    return shared_landing(spark, d)


RECONCILE_SQL = """
SELECT partition_key FROM v_meas_ledger
EXCEPT
SELECT partition_key FROM v_meas_ledger
WHERE status = 'MATERIALIZED' AND event_time < TIMESTAMP '""" + LEDGER_AS_OF + "'"


def _reconciled(spark: SparkSession, d: str) -> DataFrame:
    root = _write_measurements(spark, d)
    listed = B.list_partition_files(spark, root, "air_quality_data", ["date", "station_number"])
    storage_keys = listed.select(F.concat_ws("|", "date", "station_number").alias("partition_key"))
    known = V.measurement_ledger(spark, d).filter(F.col("event_time") < ts_lit(LEDGER_AS_OF))
    return L.reconcile_storage(storage_keys, known, "air_quality_data")


@register("reconcile_storage", with_views(RECONCILE_SQL, "v_meas_ledger"))
def q_reconcile_storage(spark, d):
    return _reconciled(spark, d)


@register("report_materialized", with_views(f"""
SELECT 'air_quality_data' AS asset_key, partition_key, 'MATERIALIZED' AS status,
       '{REPORT_NOW}' AS event_time
FROM ({RECONCILE_SQL}) r""", "v_meas_ledger"))
def q_report_materialized(spark, d):
    new = L.report_materialized(_reconciled(spark, d), "air_quality_data", ts_lit(REPORT_NOW))
    return new.select("asset_key", "partition_key", "status", F.col("event_time").cast("string").alias("event_time"))


@register("run_request_rows", with_views("""
SELECT job_name, repository_name, daily AS tag_daily, stations AS tag_stations, name AS tag_backfill,
       partition_key AS tag_partition, 'NA' AS tag_job_name, 'cicd' AS tag_triggered_by
FROM plan""", "v_backfill_checked", "v_meas_ledger", extra={"plan": PLAN_SQL}))
def q_run_request_rows(spark, d):
    plan = L.backfill_plan(V.backfills(spark, d), V.measurement_ledger(spark, d))
    rr = L.run_request_rows(plan)
    t = F.col("tags")
    return rr.select("job_name", "repository_name",
                     tag(t, TAG_PARTITION_DIM_PREFIX + "daily").alias("tag_daily"),
                     tag(t, TAG_PARTITION_DIM_PREFIX + "stations").alias("tag_stations"),
                     tag(t, TAG_BACKFILL).alias("tag_backfill"),
                     tag(t, TAG_PARTITION).alias("tag_partition"),
                     tag(t, TAG_JOB_NAME).alias("tag_job_name"),
                     tag(t, TAG_TRIGGERED_BY).alias("tag_triggered_by"))


@register("backfill_completion", with_views("""
SELECT backfill, count(*) AS n_runs,
       count(*) FILTER (WHERE status = 'SUCCESS') AS n_success,
       count(*) FILTER (WHERE status = 'FAILURE') AS n_failure,
       count(*) FILTER (WHERE status NOT IN ('SUCCESS', 'FAILURE')) AS n_unfinished,
       count(*) FILTER (WHERE status NOT IN ('SUCCESS', 'FAILURE')) = 0 AS finished
FROM v_runs WHERE backfill IS NOT NULL GROUP BY backfill""", "v_runs"))
def q_backfill_completion(spark, d):
    return L.backfill_completion(V.runs(spark, d))
