"""Near-duplicates by SimHash, linked by meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart share a variant within half the radius of both, so each one emits the
variants of its ball and equal variants collide. A ball of radius 2 over 64 bits has 2,081 variants, far too many to
send one by one. Their leading bits therefore decide where they meet: a fingerprint travels once to each block of
leading bits that its ball touches, with the flips it has left, and the remaining bits are varied behind the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import ceil, comb, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleetworks.llm.components import components
from fleetworks.llm.frames import append, hidden, named, shown
from fleetworks.session import settle

SHINGLE, SEED, RADIUS, BITS = 4, 42, 4, 64
#: Variants that one task sorts at once; blocks with more are split into slices of the variants.
SLICE_VARIANTS = 1_000_000
_HASHES = 1 << 16
#: Rows of split blocks whose variants a task looks at together.
_ROUTED = 512


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The bits set in over half of the shingle hashes. No words: zero; fewer than a shingle: all of them as one."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    spans = list(zip(starts, ends[shingle - 1:]))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), _HASHES):
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans[at:at + _HASHES]], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with its signed 64-bit ``_fp``."""
    def make():
        return lambda texts: [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

    return append(docs, text, "_fp bigint", make, keep)


def _masks(bits: int, flips: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), flips)], np.uint64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]


def _ball(low: np.ndarray, left: np.ndarray, low_bits: int, half: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The variants of each row with the flips it has left, and whose they are, about ``SLICE_VARIANTS`` at a time."""
    for flips in range(half + 1):
        able = np.flatnonzero(left >= flips)
        masks = _masks(low_bits, flips)
        for at in range(0, len(able), step := max(1, SLICE_VARIANTS // len(masks))):
            who = able[at:at + step]
            yield (low[who, None] ^ masks[None, :]).ravel(), np.repeat(who, len(masks))


def _slice_of(variants: np.ndarray, slices) -> np.ndarray:
    """The slice of a split block that holds a variant."""
    return ((variants * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % slices


def _route(batches: Iterator[pa.RecordBatch], low_bits: int, half: int) -> Iterator[pa.RecordBatch]:
    """Rows of split blocks, once for each slice that holds a variant of theirs."""
    for whole in batches:
        for start in range(0, whole.num_rows, _ROUTED):
            block, fp, left, split = (c.to_numpy() for c in whole.slice(start, _ROUTED).columns)
            low, pieces = fp.view(np.uint64) & np.uint64((1 << low_bits) - 1), split.astype(np.uint64)
            wide = pieces.max()
            # row and slice in one number
            hit = np.unique(np.concatenate([np.unique(by.astype(np.uint64) * wide + _slice_of(got, pieces[by]))
                                            for got, by in _ball(low, left, low_bits, half)]))
            row = (hit // wide).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (block[row], fp[row], left[row], split[row], (hit % wide).astype(np.int32))],
                names=["_block", "_fp", "_left", "_slices", "_slice"])


def _meet(part: pd.DataFrame, low_bits: int, half: int, radius: int) -> pd.DataFrame:
    """Links inside one slice of one block: each member with the smallest one it reaches there."""
    part = part.assign(u=part["_fp"].to_numpy().view(np.uint64)).sort_values("u")
    fp, left = part["u"].to_numpy(), part["_left"].to_numpy()
    slices, mine = np.uint64(part["_slices"].iloc[0]), np.uint64(part["_slice"].iloc[0])
    low = fp & np.uint64((1 << low_bits) - 1)
    variants, owners = [], []
    for got, by in _ball(low, left, low_bits, half):
        if slices > 1:
            own = _slice_of(got, slices) == mine
            got, by = got[own], by[own]
        variants.append(got)
        owners.append(by.astype(np.int32))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    first = np.r_[True, variant[1:] != variant[:-1]]
    head = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    met = ~first
    pairs = np.unique(np.stack([head[met], owner[met]]), axis=1)
    pairs = pairs[:, _popcount(fp[pairs[0]] ^ fp[pairs[1]]) <= radius]
    root = _forest(len(fp), pairs[0], pairs[1])
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[linked].view(np.int64), "b": fp[root[linked]].view(np.int64)})


def near_links(distinct: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints ``_fp`` connected by steps of at most ``radius`` bits.

    All members of one variant's ball are within ``radius`` of each other, so a star over them loses no connection and
    no group emits its pairs. A block holding more variants than a task should sort is split by a hash of the variant, and
    a fingerprint goes to the slices that its variants hash to: never more often than it has variants there, however
    many slices a crowded block needs.
    """
    half = (radius + 1) // 2
    high = min(24, max(10, ceil(log2(max(1, count * comb(BITS, half) / SLICE_VARIANTS)))))
    low_bits = BITS - high
    load = [sum(comb(low_bits, k) for k in range(left + 1)) for left in range(half + 1)]
    moves = [(int(m), half - flips, load[half - flips]) for flips in range(half + 1) for m in _masks(high, flips)]
    table = F.array(*[F.struct(F.lit(m).alias("_mask"), F.lit(r).alias("_left"), F.lit(w).cast("bigint").alias("_load"))
                      for m, r, w in moves])
    sent = (
        distinct.select("_fp", F.explode(table).alias("_move"))
        .select("_fp", F.expr(f"shiftrightunsigned(_fp, {low_bits})").bitwiseXOR(F.col("_move._mask")).cast("int").alias("_block"),
                "_move._left", "_move._load")
    )
    loads = sent.groupBy("_block").agg(F.sum("_load").alias("_all"))
    heavy = settle(loads.where(F.col("_all") > SLICE_VARIANTS).select(
        "_block", F.ceil(F.col("_all") / SLICE_VARIANTS).cast("int").alias("_split")), "heavy-blocks")
    whole = sent.join(heavy, "_block", "left_anti").select(
        "_block", "_fp", "_left", F.lit(1).alias("_slices"), F.lit(0).alias("_slice"))
    split = sent.join(heavy, "_block").select("_block", "_fp", "_left", "_split").mapInArrow(
        lambda batches: _route(batches, low_bits, half), "_block int, _fp bigint, _left int, _slices int, _slice int")
    placed = whole.unionByName(split)

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        return _meet(part, low_bits, half, radius)

    return placed.groupBy("_block", "_slice").applyInPandas(meet, "a bigint, b bigint").distinct()


def group_fingerprints(marked: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """One row (``_fp``, ``_root``, ``_first``) per fingerprint: its component and the component's smallest key."""
    distinct = settle(marked.groupBy("_fp").agg(F.min(named(key)).alias("_first")), "fingerprints")
    links = near_links(distinct, distinct.count(), radius)
    roots = components(links)
    labelled = distinct.join(roots.select(F.col("node").alias("_fp"), "root"), "_fp", "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_root"), "_first")
    smallest = labelled.groupBy("_root").agg(F.min("_first").alias("_first"))
    return labelled.drop("_first").join(smallest, "_root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row: its key, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key it is linked to.

    Fingerprints link at ``radius`` or fewer differing bits. Null and empty texts have fingerprint zero and link like
    any other. A null key takes no part in the minimum; a component of null keys alone has a null id. Repeated rows
    stay. An empty table gives an empty result.
    """
    marked = settle(fingerprints(docs, text, [key]), "simhash")
    groups = group_fingerprints(marked, key, radius)
    return marked.join(groups, "_fp").select(
        named(key), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_first").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the smallest key, null last; of repeated rows any one."""
    inside, names = hidden(docs)
    key = names[key]
    marked = settle(
        fingerprints(inside, names[text]).withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    light = marked.select(key, "_fp", "_row")
    stays = light.join(group_fingerprints(light, key, radius), "_fp").groupBy("_root").agg(
        F.min(F.struct(F.col(key).isNull(), key, "_row")).alias("_best")).select("_best._row")
    return shown(marked.join(stays, "_row", "left_semi"), names)
