"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the least of the node and its
    neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are hung on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of edges (u, v) but the roots, which are the
    least nodes of their components. Both steps use minima alone, so a node of
    any degree is pre-aggregated; each round is written, so lineage stays short.
    Loops, repeated edges and nulls are dropped; no edges give no rows."""
    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        edges = materialize(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == tuple(state):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
    raise RuntimeError("components did not settle")
