"""Connected components of an edge table, by alternating star contractions.

Each round hangs every node's larger neighbours (then its smaller ones) on the
smallest one it knows; trees flatten in a number of rounds that grows with the
logarithm of the longest path. A round is two aggregations and joins, and ends
in a checkpoint in the shared folder, so lineage stays short and a lost executor
costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapecraft.session import checkpoint_root


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge: root is the smallest node it reaches."""
    checkpoint_root(edges.sparkSession)
    edges = edges.select("a", "b").filter("a != b").distinct().checkpoint()
    before = None
    while True:
        edges = _small_star(_large_star(edges)).checkpoint()
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).distinct()
