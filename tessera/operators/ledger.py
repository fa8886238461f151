"""Ledger and backfill operators.

The ledger is an append-only table of (asset_key, partition_key, status,
event_time, event_id, ...) events.  Everything here is a filter, a hash
aggregate or a hash join over it:

* "latest status" is ``max(struct(event_time, event_id, status))`` per key –
  a hash aggregate with map-side partial aggregation, so a key holding a third
  of all events is pre-reduced in every task before the shuffle (a
  ``row_number`` window would sort that whole key in one task);
* membership tests are ``left_semi`` / ``left_anti`` joins, never lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import dims_map, encode_key
from tessera.functions.tags import sparse_map
from tessera.functions.timefn import as_col
from tessera.operators.partitions import day_ranges, partition_grid, validate_backfills
from tessera.schemas import (STATUS_MATERIALIZED, TAG_BACKFILL, TAG_CI_RUN_ID,
                             TAG_CI_URL, TAG_DEFAULT, TAG_JOB_NAME,
                             TAG_PARTITION, TAG_PARTITION_DIM_PREFIX,
                             TAG_TRIGGERED_BY, TERMINAL_RUN_STATUSES,
                             TRIGGERED_BY_VALUE)


class UnknownAssetError(ValueError):
    pass


class MissingPartitionsError(ValueError):
    pass


def materialized_partitions(ledger: DataFrame, asset_key: str | None = None,
                            keys: DataFrame | None = None) -> DataFrame:
    """L1: materialized keys with their event count.

    One ledger row per event, so repeats collapse here.  ``keys`` (a table with
    ``partition_key``) restricts the result, as a semi-join.
    """
    ev = ledger.filter(F.col("status") == STATUS_MATERIALIZED)
    if asset_key is not None:
        ev = ev.filter(F.col("asset_key") == asset_key)
    if keys is not None:
        ev = ev.join(keys.select("partition_key"), "partition_key", "left_semi")
    return ev.groupBy("asset_key", "partition_key").agg(F.count(F.lit(1)).alias("n_events"))


def latest_status(ledger: DataFrame) -> DataFrame:
    """L2: latest status per (asset, partition); keys never run are absent.

    Ties on event_time are broken by the larger event_id.
    """
    latest = F.max(F.struct("event_time", "event_id", "status")).alias("_l")
    return (ledger.groupBy("asset_key", "partition_key").agg(latest)
            .select("asset_key", "partition_key",
                    F.col("_l.status").alias("status"),
                    F.col("_l.event_time").alias("event_time")))


def condense(ledger: DataFrame) -> DataFrame:
    """The events that decide: per (asset, partition) the latest event and the latest MATERIALIZED one, once if they
    are the same.  Latest is as in ``latest_status``; events alike in time and id go by status, then by the other
    columns, so the result does not depend on the order of rows.

    L2 to L6, B5, B6 and the newest materialization (F5, F6) answer from these events as from all, and
    ``condense(condense(a) + b)`` is ``condense(a + b)``: a kept state needs only later events to stay up to date.  One
    hash aggregate with map-side partials; at most two rows a partition, however often it ran.
    """
    keys = ["asset_key", "partition_key"]
    order = ["event_time", "event_id", "status"]
    event = F.struct(*order, *[c for c in ledger.columns if c not in keys + order])
    done = F.max(F.when(F.col("status") == STATUS_MATERIALIZED, event))
    kept = ledger.groupBy(*keys).agg(F.array_distinct(F.array_compact(F.array(F.max(event), done))).alias("_kept"))
    return kept.select(*keys, F.explode("_kept").alias("_e")).select(*keys, "_e.*").select(*ledger.columns)


def unknown_assets(requested: DataFrame, ledger: DataFrame, asset_col: str = "asset_key") -> DataFrame:
    """L3: requested asset keys with no ledger entry at all."""
    known = ledger.select(F.col("asset_key").alias("_a")).distinct()
    req = requested.select(F.col(asset_col).alias("asset_key")).filter(F.col("asset_key").isNotNull()).distinct()
    return req.join(known, req["asset_key"] == known["_a"], "left_anti")


def check_assets_exist(requested: DataFrame, ledger: DataFrame, skip_checks: bool = False) -> None:
    """Raise ``Asset '<key>' not found`` unless ``skip_checks``; fetches one row at most."""
    if skip_checks:
        return
    first = unknown_assets(requested, ledger).limit(1).collect()
    if first:
        raise UnknownAssetError(f"Asset '{first[0]['asset_key']}' not found")


def missing_partitions(grid: DataFrame, ledger: DataFrame, asset_key: str | None = None,
                       key: str = "partition_key") -> DataFrame:
    """L4: grid rows whose key has no materialization event (hash anti-join)."""
    done = ledger.filter(F.col("status") == STATUS_MATERIALIZED)
    if asset_key is not None:
        done = done.filter(F.col("asset_key") == asset_key)
    done = done.select(F.col("partition_key").alias(key))
    return grid.join(done, key, "left_anti")


def with_asset_check(validated: DataFrame, ledger: DataFrame) -> DataFrame:
    """Adds the error ``unknown asset <key>`` to validated backfill requests
    whose asset has no ledger entry, unless the request's ``skip_checks`` is
    set: one join with the distinct assets of the ledger."""
    known = ledger.select(F.col("asset_key").alias("_known")).distinct()
    skip = F.coalesce(F.col("skip_checks"), F.lit(False)) if "skip_checks" in validated.columns else F.lit(False)
    unknown = F.col("asset_key").isNotNull() & F.col("_known").isNull() & ~skip
    joined = validated.join(known, validated["asset_key"] == known["_known"], "left")
    return (joined.withColumn("errors", F.when(unknown, F.array_append("errors", F.concat(F.lit("unknown asset "), "asset_key")))
                              .otherwise(F.col("errors")))
            .withColumn("valid", F.size("errors") == 0).drop("_known"))


def backfill_plan(requests: DataFrame, ledger: DataFrame, date_dim: str = "daily",
                  static_dim: str = "stations") -> DataFrame:
    """Valid requests -> full grid (policy ``all``) or its missing part (``missing``).

    One conditional anti-join for all requests: left join the materialized
    keys of each request's asset, keep ``policy = 'all' OR hit IS NULL``.
    Requests for an asset without any ledger entry are left out unless they
    skip the checks (see ``with_asset_check``).
    """
    valid = with_asset_check(validate_backfills(requests), ledger).filter("valid")
    grid = partition_grid(valid, {date_dim: ("start_date", "end_date")}, {static_dim: "stations"})
    grid = grid.withColumn(date_dim, F.col(date_dim).cast("string"))
    grid = grid.withColumn("partition_key", encode_key(dims_map(**{date_dim: date_dim, static_dim: static_dim})))
    done = (ledger.filter(F.col("status") == STATUS_MATERIALIZED)
            .select(F.col("asset_key").alias("_asset"), F.col("partition_key").alias("_key"))
            .distinct().withColumn("_hit", F.lit(True)))
    joined = grid.join(done, (grid["asset_key"] == done["_asset"]) & (grid["partition_key"] == done["_key"]), "left")
    return (joined.filter((F.col("policy") == "all") | F.col("_hit").isNull())
            .drop("_asset", "_key", "_hit"))


def backfill_ranges(plan: DataFrame, group_cols: tuple[str, ...] = ("name",), date_dim: str = "daily",
                    static_dim: str = "stations") -> DataFrame:
    """L5 as stretches: per request and station, the planned days as (first_day, last_day, n_days)."""
    return day_ranges(plan, [*group_cols, static_dim], date_dim)


def reconcile_storage(storage_keys: DataFrame, ledger: DataFrame, asset_key: str) -> DataFrame:
    """Keys present in storage but never reported materialized (EXCEPT DISTINCT)."""
    stored = storage_keys.select("partition_key")
    done = materialized_partitions(ledger, asset_key, keys=stored).select("partition_key")
    return stored.subtract(done)


def report_materialized(keys: DataFrame, asset_key: str, now, id_base: int = 0) -> DataFrame:
    """New MATERIALIZED ledger events for ``keys`` (to be appended).

    ``event_id`` is a deterministic hash of (asset, key, time) offset by
    ``id_base``, so a retried task writes identical rows.
    """
    t = as_col(now)
    return keys.select(
        F.lit(asset_key).alias("asset_key"), "partition_key",
        F.lit(STATUS_MATERIALIZED).alias("status"), t.alias("event_time"),
        (F.lit(id_base) + F.abs(F.xxhash64(F.lit(asset_key), "partition_key", t))).alias("event_id"))


def run_request_rows(plan: DataFrame, backfill_name_col: str = "name", dims: tuple[str, ...] = ("daily", "stations"),
                     job_name_env: str | None = None, ci_run_id: str | None = None,
                     ci_url: str | None = None) -> DataFrame:
    """One run request per planned partition: job, repository and tags.

    Tags: one ``dagster/partition/<dim>`` per dimension, the backfill name,
    the partition key and provenance values (``NA`` when not given).
    """
    pairs = [(TAG_PARTITION_DIM_PREFIX + d, F.col(d).cast("string")) for d in dims]
    pairs += [
        (TAG_BACKFILL, F.col(backfill_name_col)),
        (TAG_PARTITION, F.col("partition_key")),
        (TAG_JOB_NAME, F.coalesce(F.lit(job_name_env), F.lit(TAG_DEFAULT))),
        (TAG_CI_RUN_ID, F.coalesce(F.lit(ci_run_id), F.lit(TAG_DEFAULT))),
        (TAG_CI_URL, F.coalesce(F.lit(ci_url), F.lit(TAG_DEFAULT))),
        (TAG_TRIGGERED_BY, F.lit(TRIGGERED_BY_VALUE)),
    ]
    return plan.select("job_name", "repository_name", sparse_map(*pairs).alias("tags"))


def backfill_completion(runs: DataFrame) -> DataFrame:
    """Per backfill, finished when every run is SUCCESS or FAILURE."""
    bf = F.try_element_at(F.col("tags"), F.lit(TAG_BACKFILL))
    terminal = F.col("status").isin(*TERMINAL_RUN_STATUSES)
    return (runs.withColumn("backfill", bf).filter(F.col("backfill").isNotNull())
            .groupBy("backfill")
            .agg(F.count(F.lit(1)).alias("n_runs"),
                 F.count_if(F.col("status") == "SUCCESS").alias("n_success"),
                 F.count_if(F.col("status") == "FAILURE").alias("n_failure"),
                 F.count_if(~terminal).alias("n_unfinished"))
            .withColumn("finished", F.col("n_unfinished") == 0))
