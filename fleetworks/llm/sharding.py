"""Sharding by rendezvous hashing, in DataFrame expressions only.

Each shard draws a number for each key, and the shard with the lowest weighted draw takes the row. A new shard can only
win rows for itself, so growing from n shards to n + 1 moves about one row in n + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.llm.frames import named, without
from fleetworks.session import settle

#: Different records that one task numbers, and equal records that are numbered as one.
NUMBERED, RUN = 50_000, 65_536


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, that wins ``key``. Null keys share one shard. Weights are above 0."""
    if not weights or min(weights) <= 0:
        raise ValueError("at least one shard, and weights above 0")
    name = key.cast("string")
    draws = []
    for shard, weight in enumerate(weights):
        unit = (F.shiftrightunsigned(F.xxhash64(F.lit(shard), name), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
        draws.append(F.struct((-F.log(unit) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*draws))["shard"]


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with its shard. A clashing column is replaced; repeated rows share a shard; empty stays empty."""
    return docs.withColumn("_shard", shard_of(named(key), weights)).select(
        *[named(c) for c in without(docs, [out]).columns], F.col("_shard").alias(out))


def manifest(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
             weights: Sequence[float] | None = None) -> DataFrame:
    """One row per document: key, size, text_crc32, law ``key``, shard, slot and grown_shard (with one shard more).

    ``size`` is the text's UTF-8 bytes plus 8, 8 for null. Slots run gapless from 0 in each shard. Equal records are
    counted first and numbered as one run, and a shard's records are numbered in hashed portions, so neither many copies
    nor a large shard gathers in one task. Weights are equal if not given; the grown shard has the mean weight.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    body = F.coalesce(named(text), F.lit(""))
    records = (
        docs.select(named(key).alias("_key"), (F.octet_length(body) + 8).cast("bigint").alias("size"),
                    F.crc32(body.cast("binary")).alias("text_crc32"))
        .groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("_copies"))
    )
    grown = [*weights, sum(weights) / len(weights)]
    placed = settle(
        records.withColumn("shard", shard_of(F.col("_key"), weights)).withColumn("grown_shard", shard_of(F.col("_key"), grown)),
        "shards")
    portions = max(1, placed.count() // (NUMBERED * shards) + 1)
    placed = placed.withColumn("_portion", F.pmod(F.xxhash64("_key", "size", "text_crc32"), F.lit(portions)))
    inside = Window.partitionBy("shard", "_portion").orderBy("_key", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("shard").orderBy("_portion").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("shard", "_portion").agg(F.sum("_copies").alias("_n")).select(
        "shard", "_portion", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_at", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        totals, ["shard", "_portion"])
    runs = numbered.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(RUN).cast("bigint"))).alias("_run"))
    spread = runs.repartition("shard", "_portion", "_key", "_run").withColumn(
        "_last", F.least(F.col("_run") + RUN, F.col("_copies")) - 1)
    return spread.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard",
        F.explode(F.sequence(F.col("_before") + F.col("_at") + F.col("_run"),
                             F.col("_before") + F.col("_at") + F.col("_last"))).alias("slot"))
