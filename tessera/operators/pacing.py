"""Rate-limit pacing over call tables.

Both avoid the "one bucket = one task" trap of a plain window partitioned by
the bucket (an environment holds *all* of its calls), and that of a busy
moment, through ``operators.ordered``:

* F10 counts the calls of each (bucket, microsecond), adds the same counts with
  a minus sign one window later, and takes running totals over them.
* F11 ranks the calls of a bucket by ranges of (bucket, time, id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import ordered
from tessera.operators.ordered import running_totals
from tessera.schemas import LIMITER_DELAY_S, LIMITER_TRIES, RATE_CALLS, RATE_MINUTES


def rate_window_audit(calls: DataFrame, limit: int = RATE_CALLS, minutes: int = RATE_MINUTES,
                      bucket: str = "bucket", ts: str = "ts") -> DataFrame:
    """for every call, calls of its bucket in the trailing window
    (t - window, t], and whether that exceeds the limit.

    Same result as ``count(*) OVER (PARTITION BY bucket ORDER BY micros RANGE
    BETWEEN window-1 PRECEDING AND CURRENT ROW)``; calls without a time are
    counted among themselves.
    """
    win = minutes * 60 * 1_000_000
    timed = calls.withColumn("_us", F.unix_micros(F.col(ts)))
    starts = timed.groupBy(bucket, "_us").agg(F.count(F.lit(1)).alias("_n"))
    ends = starts.filter("_us IS NOT NULL").select(bucket, (F.col("_us") + win).alias("_us"), (-F.col("_n")).alias("_n"))
    changes = starts.unionByName(ends).groupBy(bucket, "_us").agg(F.sum("_n").alias("_n"))
    # calls without a time are a key of their own, or their count would run on into all later totals
    changes = changes.withColumn("_untimed", F.col("_us").isNull())
    inside = running_totals(changes, [bucket, "_untimed"], ["_us"], ["_n"]).select(
        F.col(bucket).alias("_bucket"), F.col("_us").alias("_at"), F.col("_n").alias("calls_in_window"))
    same = timed[bucket].eqNullSafe(inside["_bucket"]) & timed["_us"].eqNullSafe(inside["_at"])
    return (timed.join(inside, same, "left").withColumn("over_limit", F.col("calls_in_window") > limit)
            .drop("_us", "_bucket", "_at"))


def rank_in_time_order(df: DataFrame, key: str | list[str], ts: str, tie: str, block_minutes: int = RATE_MINUTES,
                       out: str = "rank") -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY ts, tie)`` for keys whose
    rows spread over time (``ordered.ranked`` needs no such thing, but writes
    the rows once): rows are cut into (key, time block)
    groups, block sizes are prefix-summed over the small (key, block) table,
    and each row's rank is its block offset plus its rank inside the block.
    Rows with a null time come first, rows with a null key rank among themselves."""
    keys = [key] if isinstance(key, str) else list(key)
    block_us = block_minutes * 60 * 1_000_000
    r = df.withColumn("_block", F.floor(F.unix_micros(F.col(ts)) / block_us))
    counts = r.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w_off), F.lit(0))).drop("_n")
    local = Window.partitionBy(*keys, "_block").orderBy(ts, tie)
    # Null keys and null times are groups of their own: joined null-safely, none is lost.
    cols = [*keys, "_block"]
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in cols})
    same = [r[c].eqNullSafe(offsets[f"_o_{c}"]) for c in cols]
    return (r.join(offsets, same, "inner").drop(*[f"_o_{c}" for c in cols])
            .withColumn(out, (F.col("_offset") + F.row_number().over(local)).cast("long"))
            .drop("_block", "_offset"))


def rate_wave_plan(requests: DataFrame, limit: int = RATE_CALLS, minutes: int = RATE_MINUTES,
                   bucket: str = "bucket", ts: str = "ts", tie: str = "call_id",
                   tries: int = LIMITER_TRIES, delay_s: int = LIMITER_DELAY_S) -> DataFrame:
    """spread requests over waves of ``limit`` calls every ``minutes``.

    Rank per bucket in (ts, tie) order -> wave = (rank - 1) div limit; wave w
    starts w·window seconds after the plan start.  ``gives_up`` flags requests
    that would wait longer than the limiter's patience of
    (tries - 1)·delay seconds.
    """
    ranked = ordered.ranked(requests, [bucket], [ts, tie])
    wave = F.floor((F.col("rank") - 1) / limit).cast("long")
    patience = (tries - 1) * delay_s
    return (ranked.withColumn("wave", wave)
            .withColumn("wait_s", F.col("wave") * (minutes * 60))
            .withColumn("gives_up", F.col("wait_s") > patience))
