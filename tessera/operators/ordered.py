"""Ranks and running totals per key that no key can make slow.

A window partitioned by a key sorts the whole key in one task.  Here the rows are dealt by ranges of (key, order), so
a key with a third of all rows fills as many ranges as its rows need, whatever its times and ties look like.  The dealt
rows are written to the shared folder with the number of their range; each (key, range) then adds up what lies before
it from a table of one row per (key, range), and only the rows of one range are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with ``_range``, the number of its range of (keys, order); written, so that every reader sees the same."""
    spark, cols = df.sparkSession, [*keys, *order]
    path = scratch_path(spark, "ordered")
    dealt = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def _with_before(dealt: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """dealt with ``_before_<name>``: the total over the key's earlier ranges.  Null keys are keys like any other."""
    per = dealt.groupBy(*keys, "_range").agg(*[t.alias(n) for n, t in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k_range"),
                        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals])
    same = [dealt[k].eqNullSafe(before[f"_k_{k}"]) for k in keys] + [dealt["_range"] == before["_k_range"]]
    return dealt.join(before, same, "left").drop("_k_range", *[f"_k_{k}" for k in keys])


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str = "rank") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``, nulls first."""
    placed = _with_before(_dealt(df, keys, order), keys, {"n": F.count(F.lit(1))})
    here = Window.partitionBy(*keys, "_range").orderBy(*order)
    return placed.withColumn(out, (F.col("_before_n") + F.row_number().over(here)).cast("long")).drop("_range", "_before_n")


def running_totals(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY order)`` in place of each of ``values``.  A key has one row for
    each value of ``order``: aggregate first."""
    placed = _with_before(_dealt(df, keys, order), keys, {v: F.sum(v) for v in values})
    here = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = {v: F.col(f"_before_{v}") + F.sum(v).over(here) for v in values}
    return placed.withColumns(totals).drop("_range", *[f"_before_{v}" for v in values])
