"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.scratch import Scratch


def _stars(edges: DataFrame) -> bool:
    """Whether every u hangs on one v that hangs on nothing itself."""
    if edges.groupBy("u").count().where("count > 1").isEmpty():
        return edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u").isEmpty()
    return False


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is its smallest node.

    Alternating large-star and small-star steps: only minima and equi-joins, each step written to the
    shared folder. Minima are written before they are joined, so both join sides are plain shuffles that
    adaptive execution may split at a hub. Links from a node to itself and repeated links do no harm;
    an empty table gives no rows. The number of steps grows with the logarithm of the longest path.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = scratch.store(edges.select(high.alias("u"), low.alias("v")).where("u > v").distinct(), "links")
    while not _stars(edges):
        back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        both = edges.unionByName(back)
        least = scratch.store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")
        # Large star: every larger neighbour of u hangs on u's smallest neighbour.
        large = back.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.store(large, "large")
        least = scratch.store(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        # Small star: u and its smaller neighbours hang on the smallest of them.
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        done = edges
        edges = scratch.store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        scratch.drop(done, large)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
