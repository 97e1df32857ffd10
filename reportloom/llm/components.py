"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "star-centres")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = written(down.groupBy("a").agg(F.min("b").alias("least")), "star-centres")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`key` and `label` (the least node of its component) of all nodes but the least ones. `edges` has long columns `a`, `b`."""
    now = edges.where("a <> b").select("a", "b")
    while True:
        now = written(_small_star(_large_star(now)), "star-edges")
        # Done once each node has one edge, to a node that has none of its own.
        parents = now.select(F.col("b").alias("a")).distinct()
        several = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
        if several.unionByName(parents.join(now.select("a"), "a", "left_semi")).isEmpty():
            return now.select(F.col("a").alias("key"), F.col("b").alias("label"))
