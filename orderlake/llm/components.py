"""Connected components by alternating stars, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for the nodes of ``a, b`` edges.

    Each round hangs a node's larger neighbours, then its smaller ones, below
    the smallest; rounds are written, so a lost executor costs no history.
    """
    edges = stage(_ordered(edges.select("a", "b")), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(least, "a").select("b", F.col("m").alias("a"))
        edges = stage(_ordered(large.select("a", "b")), "edges")
        # Here b > a: every a is a smaller neighbour of its b.
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        small = edges.join(least, "b")
        hung = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = stage(_ordered(hung), "edges")
    found = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return found.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs below one other, and none of those hangs itself."""
    above, below = (edges.select(F.col(c).alias("node"), F.lit(i).alias("below")) for i, c in enumerate("ab"))
    sides = above.unionByName(below).groupBy("node").agg(
        F.min("below").alias("least"), F.sum("below").alias("times")
    )
    return sides.where("times > 1 OR (times = 1 AND least = 0)").isEmpty()


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
