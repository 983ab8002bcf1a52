"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _larger_first(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours hang on its smallest neighbour, if that is
    smaller than the node; else they stay. (Edges run from larger to smaller.)"""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    return _larger_first(edges.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _larger_first(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def components(pairs: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``id, component`` (the smallest id) of every node of ``a, b`` pairs.

    Each round is written to the shared folder; it ends when the edges no
    longer change, which they do in a logarithmic number of rounds.
    """
    edges, mark = materialize(_larger_first(pairs), "edges"), None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 31)).alias("h")).first()
        if now == mark or not now.n:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        mark = now
        edges = materialize(_small_star(_large_star(edges)), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
