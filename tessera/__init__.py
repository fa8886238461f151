"""tessera: partitioned ingestion, ledger and run-monitoring operators on Spark.

Every operator takes and returns DataFrames (whole tables of partitions, runs
or calls); see README.md for the operator map.
"""

from tessera.operators import freshness, ledger, monitor, pacing, partitions
from tessera.plans import flows
from tessera.session import build_session, scratch_path, shared_root
from tessera.sources import fetch, rest_source, storage
from tessera.streaming import run_metrics

__all__ = ["build_session", "fetch", "flows", "freshness", "ledger", "monitor", "pacing",
           "partitions", "rest_source", "run_metrics", "scratch_path", "shared_root", "storage"]
