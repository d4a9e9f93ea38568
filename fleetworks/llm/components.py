"""Connected components by alternating stars, each round written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetworks.session import settle


def _state(edges: DataFrame) -> tuple:
    """Count and two checks of a set of edges, to see whether a round changed it."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the component's smallest node, and stands for itself.

    A hub's links are reduced to a minimum before they meet, and joined back in pieces that adaptive execution can
    split. The rounds end when one leaves the links as they were: a star around every root.
    """
    edges = settle(edges.where("a <> b").select("a", "b"), "links")
    state = _state(edges)
    while state[0]:
        edges = settle(_small_star(_large_star(edges)).distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
