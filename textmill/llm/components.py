"""Connected components of an edge table by alternating stars.

Each round is two equi-joins and aggregations on (node, neighbour) rows and is
written to the shared folder; a node of many neighbours costs one combined row
per task in the minimum and is split by adaptive execution in the join.
Nothing is gathered; the rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, to its smallest."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b), root the smallest node
    reachable; the roots themselves have no row."""
    now = written(edges.select("a", "b").where("a != b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or not state.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = written(_small_star(_large_star(now)), "edges")
