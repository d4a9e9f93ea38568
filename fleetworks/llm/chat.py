"""Conversations logged after every turn, collapsed to the longest and rendered.

Each turn adds its hash, salted with its place, to a rolling hash of the conversation's beginning. A conversation whose
whole hash is the hash of another one's beginning is a snapshot of that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.llm.frames import named
from fleetworks.session import settle

#: Turns rendered into one row.
PART = 256
_INDEX_BITS = 33


def _turn_hash(salt: int) -> Column:
    missing = [F.col(c).isNull() for c in ("role", "text")]
    return F.xxhash64(F.lit(salt), "place", *missing, "role", F.lit(salt + 1), "text")


def rolling(conversations: DataFrame) -> DataFrame:
    """(conv, place, role, text, h1, h2): turns in order, places from 1, with the 128-bit hash of all up to each.

    Turns are sorted into ranges, so that a conversation may span many tasks; each range adds what the ranges before it
    hold of the same conversation. Equal rows of one conversation count once.
    """
    turns = conversations.select(
        F.col("conv_id").alias("conv"), "turn", "role", "text").distinct()
    order = ["conv", "turn", "role", "text"]
    placed = settle(
        turns.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()), "turns")
    placed = placed.withColumn("range", F.shiftright("at", _INDEX_BITS))
    mine = Window.partitionBy("range", "conv").orderBy("at")
    # one row per conversation and range; a conversation has as many as the ranges it spans
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("conv", "range").agg(F.count("*").alias("n")).select(
        "conv", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & (a["range"] == b["range"])
    numbered = placed.join(counts, same(placed, counts)).select(
        placed["conv"], placed["range"], "at", "role", "text", "before",
        (F.col("before") + F.row_number().over(Window.partitionBy(placed["range"], placed["conv"]).orderBy("at"))).alias("place"))
    hashed = settle(numbered.withColumn("x1", _turn_hash(11)).withColumn("x2", _turn_hash(23)), "turn-hashes")
    sums = hashed.groupBy("conv", "range").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2")).select(
        "conv", "range", *[F.coalesce(F.bit_xor(s).over(earlier), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))])
    return hashed.join(sums, same(hashed, sums)).select(
        hashed["conv"], "place", "role", "text",
        *[F.bit_xor(x).over(Window.partitionBy(hashed["range"], hashed["conv"]).orderBy("at")).bitwiseXOR(F.col(b)).alias(h)
          for x, b, h in (("x1", "b1", "h1"), ("x2", "b2", "h2"))])


def collapse(conversations: DataFrame) -> DataFrame:
    """(conv, n_turns, n_snapshots, turns...): the turns of maximal conversations.

    Equal conversations leave the one with the smallest id; those that begin a longer one are left out.
    ``n_snapshots`` is the number of conversations equal to the kept one, itself included.
    """
    turns = settle(rolling(conversations), "rolling")
    whole = turns.groupBy("conv").agg(F.max(F.struct("place", "h1", "h2")).alias("w")).select("conv", "w.*")
    classes = whole.groupBy("place", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_snapshots"))
    # beginnings that are not the whole of their own conversation; one row each before they meet the classes
    ends = whole.select(F.col("conv").alias("c"), F.col("place").alias("p"))
    begins = turns.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("place") < F.col("p"))).select(
        "place", "h1", "h2").distinct()
    kept = settle(
        classes.join(begins, ["place", "h1", "h2"], "left_anti")
        .select(F.col("conv").alias("kept"), F.col("place").alias("n_turns"), "n_snapshots"), "maximal")
    return turns.join(kept, F.col("conv").eqNullSafe(F.col("kept"))).drop("kept")


def render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as chat text: conv_id, part, n_turns, n_snapshots, rendered.

    A part has up to ``PART`` turns, so that no conversation, however long, gathers in one row; parts count from 0 and
    are joined by line ends. Turns are ordered by turn, role and text, nulls first; a null role is ``unknown``, a null
    text empty; equal rows of a conversation count once. Rows without conv_id form one conversation. Empty stays empty.
    """
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")),
                    F.lit("\n<|end|>"))
    parts = (
        collapse(conversations)
        .withColumn("part", F.floor((F.col("place") - 1) / PART))
        .groupBy("conv", "part", "n_turns", "n_snapshots")
        .agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
    )
    return parts.select(F.col("conv").alias("conv_id"), "part", "n_turns", "n_snapshots",
                        F.array_join("lines.line", "\n").alias("rendered"))
