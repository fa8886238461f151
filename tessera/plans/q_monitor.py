"""Check queries for the monitoring operators M1–M5, M7–M13."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.tags import tag
from tessera.functions.timefn import ts_lit
from tessera.operators import monitor as M
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import TAG_PARTITION, TAG_RUN_KEY
from tessera.sources import testviews as V

CURSOR = "1998-01-01 00:00:00"
ENV = "dev"
BACKFILL = "backfill-3"
JOB = "air_quality_data_job"

TRIGGER_SQL = """CASE WHEN backfill IS NOT NULL THEN 'backfill' WHEN schedule IS NOT NULL THEN 'schedule'
            WHEN auto_mat IS NOT NULL AND auto_mat <> '' THEN 'auto_materialize' ELSE 'manual' END"""
TNAME_SQL = "coalesce(backfill, schedule, 'N/A')"
SINCE_SQL = f"status IN ('SUCCESS', 'FAILURE') AND update_us > epoch_us(TIMESTAMP '{CURSOR}')"


def _since(spark, d):
    return M.terminal_runs_since(V.runs(spark, d), ts_lit(CURSOR))


@register("terminal_runs_since", with_views(f"""
SELECT run_id, status, end_us FROM v_runs WHERE {SINCE_SQL}""", "v_runs"))
def q_terminal_runs_since(spark, d):
    return _since(spark, d).select("run_id", "status", F.unix_micros("end_time").alias("end_us"))


@register("trigger_type", with_views(f"""
SELECT run_id, {TRIGGER_SQL} AS trigger_type, {TNAME_SQL} AS trigger_name FROM v_runs""", "v_runs"))
def q_trigger_type(spark, d):
    return M.with_trigger(V.runs(spark, d)).select("run_id", "trigger_type", "trigger_name")


LABELS_SQL = f"""
SELECT run_id, asset_name, coalesce(partition_key, 'N/A') AS partition_key, '{ENV}' AS environment,
       location, {TRIGGER_SQL} AS trigger_type, {TNAME_SQL} AS trigger_name, status, end_us
FROM v_runs WHERE {SINCE_SQL}"""


@register("run_labels", with_views("""
SELECT run_id, asset_name, partition_key, environment, location, trigger_type, trigger_name FROM labels""",
                                   "v_runs", extra={"labels": LABELS_SQL}))
def q_run_labels(spark, d):
    return M.run_labels(_since(spark, d), ENV).drop("status", "end_time")


@register("success_points", with_views("""
SELECT 'custom.googleapis.com/dagster/asset_success' AS series_type, run_id, asset_name, partition_key,
       environment, location, trigger_type, trigger_name,
       end_us // 1000000 AS seconds, CAST((end_us % 1000000) * 1000 AS INTEGER) AS nanos,
       CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS value
FROM labels""", "v_runs", extra={"labels": LABELS_SQL}))
def q_success_points(spark, d):
    return M.success_points(M.run_labels(_since(spark, d), ENV))


@register("advance_cursor", with_views(f"""
SELECT coalesce(greatest(epoch_us(TIMESTAMP '{CURSOR}'), max(update_us)), epoch_us(TIMESTAMP '{CURSOR}')) AS cursor_us,
       count(*) AS n_runs
FROM v_runs WHERE {SINCE_SQL}""", "v_runs"))
def q_advance_cursor(spark, d):
    out = M.advance_cursor(_since(spark, d), ts_lit(CURSOR))
    return out.select(F.unix_micros("cursor").alias("cursor_us"), "n_runs")


@register("runs_for_job", with_views(f"""
SELECT run_id, status FROM v_runs WHERE job_name = '{JOB}' AND status IN ('SUCCESS', 'FAILURE')""", "v_runs"))
def q_runs_for_job(spark, d):
    return M.runs_for_job(V.runs(spark, d), JOB).select("run_id", "status")


@register("backfill_partitions", with_views(f"""
SELECT DISTINCT partition_key FROM v_runs
WHERE backfill = '{BACKFILL}' AND partition_key IN (SELECT partition_key FROM v_meas_ledger)""",
                                            "v_runs", "v_meas_ledger"))
def q_backfill_partitions(spark, d):
    return M.backfill_partitions(V.runs(spark, d), BACKFILL, V.measurement_ledger(spark, d))


@register("runs_by_trigger", with_views(f"""
SELECT run_id, status, partition_key FROM v_runs
WHERE backfill = '{BACKFILL}' AND status IN ('SUCCESS', 'FAILURE')
  AND partition_key IN (SELECT partition_key FROM v_meas_ledger)""", "v_runs", "v_meas_ledger"))
def q_runs_by_trigger(spark, d):
    r = M.runs_by_trigger(V.runs(spark, d), ("SUCCESS", "FAILURE"), V.measurement_ledger(spark, d),
                          backfill_name=BACKFILL)
    return r.select("run_id", "status", "partition_key")


@register("job_statistics", with_views(f"""
SELECT trigger_name, count(*) AS total,
       count(*) FILTER (WHERE status = 'SUCCESS') AS successful,
       count(*) FILTER (WHERE status = 'FAILURE') AS failed,
       count(*) FILTER (WHERE status IN ('SUCCESS', 'FAILURE')) AS done,
       count(*) FILTER (WHERE status NOT IN ('SUCCESS', 'FAILURE')) AS unfinished
FROM (SELECT {TNAME_SQL} AS trigger_name, partition_key, arg_max(status, (update_us, run_id)) AS status
      FROM v_runs WHERE partition_key IS NOT NULL AND (backfill IS NOT NULL OR schedule IS NOT NULL)
      GROUP BY 1, 2) t
GROUP BY trigger_name""", "v_runs"))
def q_job_statistics(spark, d):
    runs = M.with_trigger(V.runs(spark, d))
    expected = (runs.filter(F.col("trigger_type").isin("backfill", "schedule"))
                .select("trigger_name", tag("tags", TAG_PARTITION).alias("partition_key"))
                .filter(F.col("partition_key").isNotNull()).distinct())
    return M.job_statistics(expected, V.runs(spark, d))


@register("run_key_dedupe", with_views("""
SELECT run_key FROM (SELECT run_key FROM v_runs WHERE status <> 'SUCCESS' AND run_key IS NOT NULL
                     EXCEPT SELECT run_key FROM v_runs WHERE status = 'SUCCESS') k
UNION ALL
SELECT run_key FROM v_runs WHERE status <> 'SUCCESS' AND run_key IS NULL""", "v_runs"))
def q_run_key_dedupe(spark, d):
    """Unpartitioned runs have no run key; each of their requests stays."""
    runs = V.runs(spark, d)
    requests = runs.filter(F.col("status") != "SUCCESS").select(tag("tags", TAG_RUN_KEY).alias("run_key"))
    return M.run_key_dedupe(requests, runs)


@register("unfinished_counter", with_views("""
SELECT job_name || ':' || tag_station AS run_key, count(*) AS unfinished_count, count(*) >= 15 AS skip
FROM v_runs WHERE status = 'STARTED' AND tag_station IS NOT NULL GROUP BY 1""", "v_runs"))
def q_unfinished_counter(spark, d):
    runs = V.runs(spark, d).filter(F.col("status") == "STARTED")
    ticks = runs.select(F.concat_ws(":", "job_name", tag("tags", "dagster/partition/stations")).alias("run_key"),
                        tag("tags", "dagster/partition/stations").alias("_s")).filter(F.col("_s").isNotNull())
    return M.unfinished_counter(ticks)


@register("downstream_ready", with_views(f"""
SELECT daily_key, count(*) AS n_upstream,
       count(*) FILTER (WHERE status IS NULL OR status NOT IN ('SUCCESS', 'FAILURE')) AS n_unfinished,
       count(*) FILTER (WHERE status IS NULL OR status NOT IN ('SUCCESS', 'FAILURE')) = 0 AS ready
FROM (SELECT DISTINCT tag_daily AS daily_key, partition_key FROM v_runs WHERE partition_key IS NOT NULL) e
LEFT JOIN (SELECT partition_key, arg_max(status, (update_us, run_id)) AS status FROM v_runs
           WHERE job_name = '{JOB}' AND partition_key IS NOT NULL GROUP BY partition_key) t USING (partition_key)
GROUP BY 1""", "v_runs"))
def q_downstream_ready(spark, d):
    """A day needs every partition that any job has a run for; many of them have never run in this job."""
    runs = V.runs(spark, d)
    expected = (runs.select(tag("tags", "dagster/partition/daily").alias("daily_key"),
                            tag("tags", TAG_PARTITION).alias("partition_key"))
                .filter(F.col("partition_key").isNotNull()).distinct())
    return M.downstream_ready(expected, runs.filter(F.col("job_name") == JOB))
