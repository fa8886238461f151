"""Connected components of a distributed graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges: (a bigint, b bigint), each link once at least, in any direction.  Returns (node, root) for every
    node with a link; root is the component's smallest node.

    Each round links every node's larger neighbours to its smallest neighbour (large star), then every node and
    its smaller neighbours to the smallest of them (small star).  Rounds grow with the logarithm of the
    component's size.  Minima are aggregates and the rest are joins that may be split, so a node with very many
    links is no bottleneck.  Each round is a written table in the shared folder.
    """
    pairs = base.written(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                                              F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v"), F.col("u")))  # u: node, v: neighbour
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (pairs.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small_least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        pairs = base.written(spark, small, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
