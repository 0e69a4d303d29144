"""Connected components by alternating stars, every round one join and one aggregation on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node with an edge (a, b); a component is named by its smallest node.

    Edges shrink to one star for each component. A round is written, so a lost executor costs a re-read.
    """
    now, seen = scratch.table(edges.select("a", "b").filter("a <> b"), "edges"), None
    while True:
        before, now = now, scratch.table(_small_star(_large_star(now)), "stars")
        scratch.drop(before)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
