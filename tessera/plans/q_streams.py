"""Check query for the streaming operator M6: a real Structured Streaming query
with ``availableNow`` over files written from the test tables, then the sink is
read."""

from __future__ import annotations

from tessera.plans.q_monitor import TNAME_SQL, TRIGGER_SQL
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.session import scratch_path
from tessera.sources import testviews as V
from tessera.streaming import run_metrics

ENV = "dev"


@register("stream_run_metrics", with_views(f"""
SELECT 'custom.googleapis.com/dagster/asset_success' AS series_type, run_id, asset_name,
       coalesce(partition_key, 'N/A') AS partition_key, '{ENV}' AS environment, location,
       {TRIGGER_SQL} AS trigger_type, {TNAME_SQL} AS trigger_name,
       end_us // 1000000 AS seconds, CAST((end_us % 1000000) * 1000 AS INTEGER) AS nanos,
       CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS value
FROM v_runs WHERE status IN ('SUCCESS', 'FAILURE')""", "v_runs"))
def q_stream_run_metrics(spark, d):
    """Two thirds of the runs come first; after a restart all come, so some are
    late by any measure and some are seen again.  Each terminal run is reported
    once."""
    root = scratch_path(spark, "m6")
    runs = V.runs(spark, d)
    runs.filter("pmod(xxhash64(run_id), 3) > 0").write.mode("append").parquet(f"{root}/source")
    run_metrics.start_run_metrics(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", ENV).awaitTermination()
    runs.write.mode("append").parquet(f"{root}/source")
    q = run_metrics.start_run_metrics(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", ENV)
    q.awaitTermination()
    return run_metrics.read_points(spark, f"{root}/sink").drop("batch_id")
