"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node the smallest neighbour (partial sums first, so hubs are harmless)."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    linked = both.where(F.col("v") > F.col("u")).join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the smallest one. u > v holds."""
    least = _smallest(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.where(F.col("u") > F.col("v")).unionByName(own).distinct()


def _unfinished(edges: DataFrame) -> DataFrame:
    """Nodes that keep the edges from being a forest of stars: children with several parents or that are parents."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    seen = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return seen.where(F.col("child") + F.col("parent") > 1)


def components(edges: DataFrame, a: str, b: str, written: bool = False) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with an edge.

    Alternates large-star and small-star steps until every node points at its
    root alone; each round is written to the shared folder. Null ends and loops are
    dropped. No edges give no rows. written: the edges come from files and hardly repeat,
    so the first round reads them from there.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v"))
    if not written:
        edges = staged(edges.distinct(), "edges")
    while True:
        after = staged(_small_star(_large_star(edges)), "edges")
        discard(edges)  # the round is written: nothing goes back to the one before
        if _unfinished(after).isEmpty():
            break
        edges = after
    roots = after.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
