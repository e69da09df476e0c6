"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.functions.session import release, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node sends its larger (or its smaller) neighbours to its smallest neighbour.

    Minima are aggregated before the shuffle, and a hub meets its neighbours in an
    equi-join that adaptive execution may split, so no node's neighbours are gathered.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u").filter("v > u").select(F.col("v"), "m")
    else:
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # v < u
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        sent = down.join(least, "u").filter("v > m").select("v", "m")
        moved = sent.unionByName(least.select(F.col("u").alias("v"), "m"))
    return moved.filter("v > m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest node.

    edges: (a, b) with a < b, in any order, repeats allowed. Rounds are written to
    shared storage, so a lost executor costs one round at most. The number of
    rounds grows with the logarithm of the longest chain; not settling in
    `rounds` raises. Runs jobs.
    """
    current = first = edges.select("a", "b")
    for _ in range(rounds):
        before, current = current, stored(_star(_star(current, large=True), large=False), "star")
        if before is not first:
            release(before)
        if _settled(current):
            heads = current.select(F.col("a").alias("node"), F.col("a").alias("component"))
            leaves = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
            return leaves.unionByName(heads.distinct())
    raise RuntimeError("components did not settle")


def _settled(edges: DataFrame) -> bool:
    """All stars: every larger end has one edge, and is no other edge's smaller end."""
    ends = edges.select(F.col("b").alias("u"), F.lit(1).alias("leaf"), F.lit(0).alias("head")).unionByName(
        edges.select(F.col("a").alias("u"), F.lit(0).alias("leaf"), F.lit(1).alias("head"))
    )
    per_node = ends.groupBy("u").agg(F.sum("leaf").alias("leaf"), F.max("head").alias("head"))
    return per_node.filter("leaf > 1 OR (leaf = 1 AND head = 1)").isEmpty()
