"""Connected components with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonweave.llm.common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's smallest node.

    Large-star and small-star rounds in turn: each node's neighbours move to the smallest of them, until
    every edge leads to a root. The number of rounds grows with the logarithm of the longest path. Each round
    ends in a checkpoint; the driver only learns whether all edges are stars yet.
    """
    pairs = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _all_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = moved.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        own = low.select("a", F.col("m").alias("b"))
        pairs = durable(small.unionByName(own).where("a <> b").distinct())
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _all_stars(pairs: DataFrame) -> bool:
    """Whether each node leads to one root, and no root leads further."""
    ends = pairs.select("a", F.lit(1).alias("out")).unionByName(pairs.select(F.col("b").alias("a"), F.lit(0).alias("out")))
    degree = ends.groupBy("a").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return degree.where("out > 1 OR (out = 1 AND least = 0)").isEmpty()
