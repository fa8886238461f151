"""Freshness and change detection as table operators.

These answer "which partitions are due / stale / changed / retryable now?"
over the ledger; they schedule nothing.  "Now" is an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.timefn import as_col, daily_cron_tick, last_closed_day, monthly_cron_tick
from tessera.operators import ordered
from tessera.schemas import (FRESHNESS_MAX_LAG_MIN, PARTITION_TZ, RETRY_DELAY_S,
                             RETRY_MAX, STATUS_MATERIALIZED)


def row_fingerprint(cols: list[str]) -> tuple:
    """Per-row md5 over a canonical text of ``cols``; hex digits 1–8 and 9–16
    as two non-negative bigints.  Doubles are cast to decimal and timestamps
    to epoch microseconds first so the text is engine-independent."""
    h = F.md5(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]))
    hi = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    lo = F.conv(F.substring(h, 9, 8), 16, 10).cast("long")
    return hi, lo


def exact_text(c: Column) -> Column:
    """A double as four integers, from the bits above 2^40 down to those of 2^-140, so that no change is too small
    to show.  Values outside 2^-80 .. 2^100 are scaled by a power of 2^100 first, which goes in front.  Scaling by
    powers of two and floors are exact, so every engine writes the same text."""
    size = F.abs(c)
    odd = F.isnan(c) | (size == float("inf"))
    k = F.when((size >= 2.0 ** 100) | ((size > 0) & (size < 2.0 ** -80)),
               F.floor(F.log2(size) / 100)).otherwise(F.lit(0)).cast("double")
    s = c * F.pow(F.lit(2.0), -100 * k)
    a = F.floor(s * 2.0 ** -40)
    r1 = s - a.cast("double") * 2.0 ** 40
    b = F.floor(r1 * 2.0 ** 20)
    r2 = r1 - b.cast("double") * 2.0 ** -20
    m = F.floor(r2 * 2.0 ** 80)
    r3 = r2 - m.cast("double") * 2.0 ** -80
    e = F.floor(r3 * 2.0 ** 140)
    parts = [k.cast("bigint"), a, b, m, e]
    return (F.when(odd, F.when(F.isnan(c), F.lit("nan")).when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(c.isNotNull(), F.concat_ws(":", *[x.cast("string") for x in parts])))


def canonical(df: DataFrame) -> DataFrame:
    """Doubles as exact text and timestamps as epoch micros."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float"):
            cols.append(exact_text(F.col(f.name).cast("double")).alias(f.name))
        elif t.startswith("timestamp"):
            cols.append(F.unix_micros(F.col(f.name).cast("timestamp")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def data_version(df: DataFrame, partition_cols: list[str], value_cols: list[str]) -> DataFrame:
    """order-insensitive content fingerprint per partition.

    Sum of the two 32-bit halves of each row's md5 plus the row count: an
    associative aggregate, so it partial-aggregates map-side and needs no
    sort.  (The orchestrator's SHA-256 over pandas row hashes is order- and
    index-sensitive; ours deliberately is not, a distributed table has no
    row order.)
    """
    c = canonical(df.select(*partition_cols, *value_cols))
    hi, lo = row_fingerprint(value_cols)
    agg = c.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(hi).alias("h1"), F.sum(lo).alias("h2"))
    return agg.withColumn("data_version", _version(*[F.col(c) for c in VERSION_PARTS]))


def changed_partitions(versions: DataFrame, key_cols: list[str], order_col: str = "run") -> DataFrame:
    """F2 over a whole history: per partition and run, ``new`` (first version)
    and ``changed`` (differs from the previous run's version, null-safe).

    ``order_col`` is any increasing column.  Versions are ranked per partition
    by ranges and the previous version is fetched by an equi-join on
    (partition, rank - 1) – unique keys, so a partition with a very long history
    is not sorted in one task.  To look at one more run, ``merge_versions``
    against the state of the runs before needs no rank at all.
    """
    ranked = ordered.ranked(versions, key_cols, [order_col], out="_n")
    prev = ranked.select(*[F.col(c).alias(f"_p_{c}") for c in key_cols], (F.col("_n") + 1).alias("_p_n"),
                         F.col("data_version").alias("prev_version"))
    same = [ranked[c].eqNullSafe(prev[f"_p_{c}"]) for c in key_cols] + [ranked["_n"] == prev["_p_n"]]
    out = ranked.join(prev, same, "left").drop("_p_n", *[f"_p_{c}" for c in key_cols])
    return (out.withColumn("new", F.col("_n") == 1)
            .withColumn("changed", ~F.col("data_version").eqNullSafe(F.col("prev_version"))).drop("_n"))


VERSION_PARTS = ["n_rows", "h1", "h2"]


def _version(n_rows: Column, h1: Column, h2: Column) -> Column:
    return F.concat_ws("-", n_rows.cast("string"), h1.cast("string"), h2.cast("string"))


def merge_versions(state: DataFrame, versions: DataFrame, key_cols: list[str]) -> DataFrame:
    """F2 for one run: the last version of every partition (``state``) against those of a run (``versions``), both as
    ``data_version`` gives them, one row a partition.

    Every partition of either side with its version after the run (n_rows, h1, h2, data_version), ``prev_version``
    and ``seen`` (in the run), ``new``, ``changed`` (a new partition has changed): one equi-join, which is also the
    next state.  A partition that the run did not look at keeps its version.
    """
    now, old = versions.alias("now"), state.alias("old")
    same = F.lit(True)
    for c in key_cols:
        same = same & F.col(f"now.{c}").eqNullSafe(F.col(f"old.{c}"))
    joined = now.join(old, same, "full")
    seen, known = F.col("now.data_version").isNotNull(), F.col("old.data_version").isNotNull()
    return joined.select(
        *[F.when(seen, F.col(f"now.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in key_cols],
        *[F.when(seen, F.col(f"now.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in [*VERSION_PARTS, "data_version"]],
        F.col("old.data_version").alias("prev_version"), seen.alias("seen"), (seen & ~known).alias("new"),
        (seen & ~F.col("now.data_version").eqNullSafe(F.col("old.data_version"))).alias("changed"))


def adjust_versions(state: DataFrame, added: DataFrame, removed: DataFrame, key_cols: list[str],
                    value_cols: list[str]) -> DataFrame:
    """The state after some rows came and others went, without reading the rest: fingerprints are sums, so those of
    the rows added are added and those of the rows removed taken off.  A partition without rows left is gone."""
    plus = data_version(added, key_cols, value_cols)
    minus = data_version(removed, key_cols, value_cols)
    every = [d.select(*key_cols, *[(sign * F.col(c)).alias(c) for c in VERSION_PARTS])
             for d, sign in ((state, 1), (plus, 1), (minus, -1))]
    total = every[0].unionByName(every[1]).unionByName(every[2]).groupBy(*key_cols).agg(
        *[F.sum(c).alias(c) for c in VERSION_PARTS])
    return total.filter(F.col("n_rows") > 0).withColumn("data_version", _version(*[F.col(c) for c in VERSION_PARTS]))


def _last_materialized(ledger: DataFrame, asset_key: str, key: str = "partition_key") -> DataFrame:
    return (ledger.filter((F.col("asset_key") == asset_key) & (F.col("status") == STATUS_MATERIALIZED))
            .groupBy(key).agg(F.max("event_time").alias("last_materialized")))


def cron_due_latest(partitions: DataFrame, ledger: DataFrame, asset_key: str, now, hour: int = 3,
                    tz: str = PARTITION_TZ) -> DataFrame:
    """daily ``0 <hour> * * *`` rule for the *latest* time partition only
    (last finished local day, every station): due when not materialized since
    the most recent tick."""
    tick = daily_cron_tick(as_col(now), hour, tz)
    latest = partitions.filter(F.col("date") == last_closed_day(as_col(now), tz))
    j = latest.join(_last_materialized(ledger, asset_key), "partition_key", "left")
    return j.withColumn("tick", tick).withColumn(
        "due", F.col("last_materialized").isNull() | (F.col("last_materialized") < F.col("tick")))


def cron_due_all(partitions: DataFrame, ledger: DataFrame, asset_key: str, now, tz: str = PARTITION_TZ) -> DataFrame:
    """monthly ``0 0 1 * *`` rule over *all* partitions."""
    tick = monthly_cron_tick(as_col(now), tz)
    j = partitions.join(_last_materialized(ledger, asset_key), "partition_key", "left")
    return j.withColumn("tick", tick).withColumn(
        "due", F.col("last_materialized").isNull() | (F.col("last_materialized") < F.col("tick")))


def due_missing(partitions: DataFrame, ledger: DataFrame, asset_key: str) -> DataFrame:
    """partitions with no ledger event of the asset at all (any status)."""
    seen = ledger.filter(F.col("asset_key") == asset_key).select("partition_key").distinct()
    return partitions.join(seen, "partition_key", "left_anti")


def due_parent_updated(children: DataFrame, parent_updates: DataFrame, key: str = "child_key") -> DataFrame:
    """child partitions older than their newest parent update.

    ``children``: (child_key, child_time); ``parent_updates``: (child_key,
    parent_time) already mapped to the child (e.g. by P8).  Parents are
    pre-aggregated per child before the join.
    """
    newest = parent_updates.groupBy(key).agg(F.max("parent_time").alias("newest_parent"))
    j = children.join(newest, key, "left")
    return j.withColumn("due", F.col("newest_parent").isNotNull() &
                        (F.col("child_time").isNull() | (F.col("newest_parent") > F.col("child_time"))))


def parents_updated_gate(children: DataFrame, parent_updates: DataFrame, parent_assets: list[str],
                         key: str = "child_key") -> DataFrame:
    """run the child only if *every* parent asset has some update after
    the child's last materialization (not every parent partition is needed).
    Missing or outdated parents do not block by themselves."""
    per_asset = parent_updates.filter(F.col("parent_asset").isin(parent_assets)).groupBy(key, "parent_asset").agg(F.max("parent_time").alias("parent_time"))
    j = per_asset.join(children, key, "inner")
    fresh = j.groupBy(key).agg(
        F.count_if(F.col("child_time").isNull() | (F.col("parent_time") > F.col("child_time"))).alias("n_updated"))
    out = children.join(fresh, key, "left").fillna(0, ["n_updated"])
    return out.withColumn("run", F.col("n_updated") == len(parent_assets))


def freshness_lag(latest: DataFrame, now, max_lag_minutes: int = FRESHNESS_MAX_LAG_MIN,
                  tz: str = PARTITION_TZ) -> DataFrame:
    """F8: minutes the latest materialization is behind the most recent
    monthly tick (0 when it is after it); violation beyond the allowed lag."""
    tick = monthly_cron_tick(as_col(now), tz)
    behind = (F.unix_micros(tick) - F.unix_micros(F.col("last_materialized"))) / 60_000_000
    lag = F.when(F.col("last_materialized").isNull(), F.lit(None)).otherwise(
        F.greatest(F.floor(behind), F.lit(0)).cast("long"))
    return (latest.withColumn("tick", tick).withColumn("lag_minutes", lag)
            .withColumn("violation", F.col("lag_minutes").isNull() | (F.col("lag_minutes") > max_lag_minutes)))


def retry_schedule(failures: DataFrame, key: str = "run_key", max_retries: int = RETRY_MAX,
                   delay_s: int = RETRY_DELAY_S) -> DataFrame:
    """attempt number per key (by failure time, then id); next action is
    ``dead_letter`` for permanent failures (HTTP 500), ``retry`` while
    attempts <= max_retries, else ``give_up``.  The exponential delay
    delay·2^(n-1) with ± jitter is returned as an [earliest, latest] window
    (jitter as bounds, ±50 %, our choice) so the result is deterministic.
    Attempts are numbered by ranges of (key, time, id), so a key with a flood
    of failures is not sorted in one task."""
    ranked = ordered.ranked(failures, [key], ["failed_at", "attempt_id"], out="attempt")
    base_us = F.lit(delay_s * 1_000_000) * F.pow(F.lit(2), F.col("attempt") - 1).cast("long")
    t = F.unix_micros("failed_at")
    action = (F.when(F.col("permanent"), F.lit("dead_letter"))
              .when(F.col("attempt") <= max_retries, F.lit("retry")).otherwise(F.lit("give_up")))
    return (ranked.withColumn("action", action)
            .withColumn("earliest_us", F.when(F.col("action") == "retry", t + base_us / 2).cast("long"))
            .withColumn("latest_us", F.when(F.col("action") == "retry", t + base_us * 3 / 2).cast("long")))
