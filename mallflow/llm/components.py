"""Connected components by alternating large and small stars, every step stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.llm.frames import stored


def _starred(pairs: DataFrame, to_self: bool) -> DataFrame:
    """Every neighbour ``b`` of ``a`` with the least of ``a`` and its neighbours."""
    # Stored, so that the join has plain shuffles on both sides and a node with very many neighbours can be split.
    least = stored(pairs.groupBy("a").agg(F.min("b").alias("least")), "least", narrow=True)
    joined = pairs.join(least, "a").withColumn("least", F.least("a", "least"))
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))) if to_self else moved


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every first node has one second node, and no second node is a first one: then nothing moves any more."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(2).alias("ends")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(1).alias("ends")).distinct()
    )
    # A first node alone adds up to 2, a second node to 1; anything more is no star.
    return ends.groupBy("node").agg(F.sum("ends").alias("ends")).where("ends > 2").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``edges`` (columns ``a`` and ``b``).

    Nodes are of any type with an order. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.select("a", "b").where("a <> b")
    pairs = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", narrow=True)
    while not _are_stars(pairs):
        large = stored(_starred(_both_ways(pairs), to_self=False).where("a > b").distinct(), "large", narrow=True)
        pairs = stored(_starred(large, to_self=True).where("a > b").distinct(), "small", narrow=True)
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
