"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored_at
from tidemark.sinks import folders


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of edges (a, b) with the smallest node reachable from it.

    Each step hangs the neighbours of a node under its smallest neighbour. Minima are combined
    before the shuffle and joined back, so a node with a third of all edges is split like any
    skewed join. Steps hand over through tables in the shared folder, each removed once the next is
    there, until no edge moves: a number of steps that grows with the logarithm of the edges.
    """
    lower, higher = F.least("a", "b"), F.greatest("a", "b")
    clean = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    current, folder = stored_at(clean.select(higher.alias("a"), lower.alias("b")).distinct(), "edges")
    before = None
    while True:
        following, next_folder = stored_at(_small_star(_large_star(current)), "edges")
        folders.remove(edges.sparkSession, folder)
        current, folder = following, next_folder
        # Stars only: stable once no edge moves.
        after = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if after == before:
            roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        before = after


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go under the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    # A node without smaller neighbours is its own smallest.
    moved = both.filter(F.col("b") > F.col("a")).join(least, "a", "left")
    return moved.select(F.col("b").alias("a"), F.coalesce("least", "a").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go under the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).filter(F.col("a") != F.col("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
