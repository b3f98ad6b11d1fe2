"""Connected components of an edge table by rounds of large and small stars, each a grouping and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerofuse.session import materialize_counted


def components(edges: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component.

    Edges of a node with itself only name it. Every round is written to the shared folder, which cuts the
    lineage; the number of rounds grows with the logarithm of the longest path.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    apart = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # A node with many edges first ties its neighbours to the least of them, which leaves few edges.
    stars, n = materialize_counted(_small_star(apart), f"{label}-0")
    for k in range(1, rounds + 1):
        if n == 0:
            break
        grown = _large_star(stars)
        shrunk, n = materialize_counted(_small_star(grown), f"{label}-{k}")
        # A forest of stars is the fixed point: no root is itself attached to another node.
        loose = shrunk.select("b").distinct().join(shrunk.select(F.col("a").alias("b")), "b", "left_semi")
        stars = shrunk
        if loose.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return nodes.join(stars.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Attach every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Attach a node and its lesser neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
