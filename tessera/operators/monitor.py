"""Run monitoring: terminal runs since a cursor, labels and trigger, success
points, cursor advance, job statistics and downstream gating (M1–M5, M7–M13).

Runs are rows of ``(run_id, job_name, status, asset_selection, location,
tags map, update_time, end_time)``.  Everything is a filter, projection, hash
aggregate (with map-side partial aggregation) or hash join.  "Latest run of
a partition" is ``max(struct(update_time, run_id, status))`` per key, never a
sort of the whole key: a run in flight has no end time, but it has been updated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.tags import tag, tag_or, trigger_name, trigger_type
from tessera.functions.timefn import as_col, epoch_split
from tessera.schemas import (LABEL_DEFAULT, SUCCESS_SERIES, TAG_BACKFILL,
                             TAG_PARTITION, TAG_RUN_KEY, TAG_SCHEDULE,
                             TERMINAL_RUN_STATUSES, UNFINISHED_SKIP_THRESHOLD)


def terminal_runs_since(runs: DataFrame, cursor, time_col: str = "update_time") -> DataFrame:
    """M1: SUCCESS / FAILURE runs updated strictly after ``cursor``.

    Filter and cursor (M5) use the same column, so no run is skipped or
    reported twice; the predicate is pushed into the Parquet scan.
    """
    return runs.filter(F.col("status").isin(*TERMINAL_RUN_STATUSES) & (F.col(time_col) > as_col(cursor)))


def with_trigger(runs: DataFrame) -> DataFrame:
    """M2: (trigger_type, trigger_name) from tags."""
    return runs.withColumn("trigger_type", trigger_type("tags")).withColumn("trigger_name", trigger_name("tags"))


def run_labels(runs: DataFrame, environment: str) -> DataFrame:
    """M3: metric labels of a run.  The asset is the first selected one
    (null-safe for an empty selection); partition defaults to ``N/A``."""
    r = with_trigger(runs)
    return r.select(
        "run_id", "status", "end_time",
        F.get("asset_selection", 0).alias("asset_name"),
        tag_or("tags", TAG_PARTITION, LABEL_DEFAULT).alias("partition_key"),
        F.lit(environment).alias("environment"),
        "location", "trigger_type", "trigger_name")


def success_points(labels: DataFrame, now=None, series_type: str = SUCCESS_SERIES) -> DataFrame:
    """M4: one point per run: value 1 for success else 0, exact (seconds,
    nanos) of the end time, ``now`` when it is missing."""
    t = F.col("end_time") if now is None else F.coalesce(F.col("end_time"), as_col(now))
    seconds, nanos = epoch_split(t)
    label_cols = [c for c in labels.columns if c not in ("status", "end_time")]
    return labels.select(
        F.lit(series_type).alias("series_type"), *label_cols,
        seconds.alias("seconds"), nanos.alias("nanos"),
        F.when(F.col("status") == "SUCCESS", 1).otherwise(0).alias("value"))


def advance_cursor(new_runs: DataFrame, old_cursor, time_col: str = "update_time") -> DataFrame:
    """M5: one row, ``cursor = max(old, max(time))``; unchanged without rows."""
    old = as_col(old_cursor)
    return new_runs.agg(F.coalesce(F.greatest(old, F.max(time_col)), old).alias("cursor"),
                        F.count(F.lit(1)).alias("n_runs"))


def runs_for_job(runs: DataFrame, job_name: str, statuses=TERMINAL_RUN_STATUSES) -> DataFrame:
    """M7."""
    return runs.filter((F.col("job_name") == job_name) & F.col("status").isin(*statuses))


def backfill_partitions(runs: DataFrame, backfill_name: str, upstream: DataFrame) -> DataFrame:
    """M8: partitions that runs of ``backfill_name`` were launched for,
    restricted to known upstream partitions (semi-join), distinct."""
    r = runs.select(tag("tags", TAG_BACKFILL).alias("backfill"),
                    tag("tags", TAG_PARTITION).alias("partition_key"))
    r = r.filter(F.col("backfill") == backfill_name).select("partition_key").distinct()
    return r.join(upstream.select("partition_key"), "partition_key", "left_semi")


def runs_by_trigger(runs: DataFrame, statuses, partitions: DataFrame,
                    backfill_name: str | None = None, schedule_name: str | None = None) -> DataFrame:
    """M9: runs with given statuses on given partitions for one backfill or
    one schedule name (backfill wins when both are given)."""
    if backfill_name is not None:
        cond = tag("tags", TAG_BACKFILL) == backfill_name
    elif schedule_name is not None:
        cond = tag("tags", TAG_SCHEDULE) == schedule_name
    else:
        raise ValueError("backfill_name or schedule_name is required")
    r = runs.filter(cond & F.col("status").isin(*statuses)).withColumn(
        "partition_key", tag("tags", TAG_PARTITION))
    return r.join(partitions.select("partition_key"), "partition_key", "left_semi")


def latest_run_per_partition(runs: DataFrame, group_cols: list[str]) -> DataFrame:
    """Latest run (by update time, then run id) per group, one in flight
    included: partial-aggregated."""
    latest = F.max(F.struct("update_time", "run_id", "status")).alias("_l")
    return runs.groupBy(*group_cols).agg(latest).select(
        *group_cols, F.col("_l.status").alias("status"), F.col("_l.run_id").alias("run_id"))


def job_statistics(expected: DataFrame, runs: DataFrame, trigger_col: str = "trigger_name") -> DataFrame:
    """Per trigger: total, successful, failed, done, unfinished.

    ``expected``: (trigger_name, partition_key) the trigger should cover.  The
    latest run of each expected partition decides; no run = unfinished.
    done = successful + failed, unfinished = total - done.
    """
    r = with_trigger(runs).withColumn("partition_key", tag("tags", TAG_PARTITION))
    latest = latest_run_per_partition(r.filter(F.col("partition_key").isNotNull()),
                                      [trigger_col, "partition_key"])
    j = expected.select(trigger_col, "partition_key").join(latest, [trigger_col, "partition_key"], "left")
    stats = j.groupBy(trigger_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("status") == "FAILURE").alias("failed"))
    return (stats.withColumn("done", F.col("successful") + F.col("failed"))
            .withColumn("unfinished", F.col("total") - F.col("done")))


def run_key_dedupe(requests: DataFrame, runs: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Drop trigger requests whose run key was already requested in this
    tick (dedupe) or already completed successfully (anti-join).  Requests
    without a run key ask for no such check and all stay.  Of several requests
    of one key the first by ``order_cols`` stays (default: by all columns that
    have an order, nulls first)."""
    others = [c for c in requests.columns if c != "run_key"]
    if order_cols is None:
        order_cols = [c for c in others if not isinstance(requests.schema[c].dataType, (T.MapType, T.VariantType))]
    done = (runs.filter(F.col("status") == "SUCCESS")
            .select(tag("tags", TAG_RUN_KEY).alias("run_key")).filter(F.col("run_key").isNotNull()))
    asked = requests.filter(F.col("run_key").isNotNull()).join(done, "run_key", "left_anti")
    if order_cols:
        first = F.min_by(F.struct(*others), F.struct(*order_cols)).alias("_first")
        keyed = asked.groupBy("run_key").agg(first).select("run_key", "_first.*")
    else:
        keyed = asked.dropDuplicates(["run_key"])
    return keyed.select(*requests.columns).unionByName(requests.filter(F.col("run_key").isNull()))


def unfinished_counter(tick_log: DataFrame, threshold: int = UNFINISHED_SKIP_THRESHOLD) -> DataFrame:
    """How many ticks each run key was seen unfinished; ``skip`` once the
    count reaches the threshold (>=, our choice)."""
    return (tick_log.groupBy("run_key").agg(F.count(F.lit(1)).alias("unfinished_count"))
            .withColumn("skip", F.col("unfinished_count") >= threshold))


def downstream_ready(expected: DataFrame, upstream_runs: DataFrame) -> DataFrame:
    """Daily partitions whose upstream (day, station) partitions have all
    finished; failures count as finished.  ``expected``: (daily_key,
    partition_key), every upstream partition a day needs (P7); one that has
    never run is unfinished.  Per day: upstream partitions, how many are
    unfinished (no run, or the latest one not terminal), and ``ready``."""
    r = upstream_runs.withColumn("partition_key", tag("tags", TAG_PARTITION)).filter(
        F.col("partition_key").isNotNull())
    latest = latest_run_per_partition(r, ["partition_key"])
    j = expected.select("daily_key", "partition_key").join(latest, "partition_key", "left")
    finished = F.coalesce(F.col("status").isin(*TERMINAL_RUN_STATUSES), F.lit(False))
    return (j.groupBy("daily_key")
            .agg(F.count(F.lit(1)).alias("n_upstream"), F.count_if(~finished).alias("n_unfinished"))
            .withColumn("ready", F.col("n_unfinished") == 0))
