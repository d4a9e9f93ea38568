"""Removal of word sequences that occur more than once, by level-wise doubling.

Short stretches are tested first, and only windows whose stretch is repeated are extended to twice that length, up to
the window itself. At a level below the last, a window is judged by one stretch inside it, the one with the smallest
hash: equal windows choose the same one, so no repeated window is lost, and neighbouring windows mostly share it, so
few stretches travel.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleetworks.llm.frames import append, named
from fleetworks.llm.words import spaced_words
from fleetworks.session import settle

WINDOW = 35
#: The first level is the window halved as long as at least so many words are left.
FIRST = 8
#: Bits of the filter that keeps texts without candidates out of a shuffle: per text, and at most.
FILTER_BITS, FILTER_MOST = 16, 1 << 27

_BASE = np.uint64(0x9E3779B97F4A7C15)


def levels(window: int) -> list[int]:
    """Lengths from short to the window, each at most twice the one before."""
    lengths = [window]
    while (half := -(-lengths[0] // 2)) >= FIRST:
        lengths.insert(0, half)
    return lengths


def _stretch_hashes(words: list[bytes], length: int) -> np.ndarray:
    """A hash for every ``length`` consecutive words, doubled up from single words."""
    digest = xxhash.xxh64_intdigest
    power = np.array([digest(w) for w in words], np.uint64)
    whole, size, have = None, 1, 0
    left = length
    while left:
        if left & 1:
            if whole is None:
                whole, have = power, size
            else:
                n = len(power) - have
                whole, have = power[:n] * _BASE ** np.uint64(have) + whole[size:size + n], have + size
        left >>= 1
        if left:
            n = len(power) - size
            power = power[:n] * _BASE ** np.uint64(size) + power[size:]
            size *= 2
    return whole


def _smallest(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``width`` neighbours the smallest hash and its first place."""
    h, p, size = hashes, np.arange(len(hashes)), 1
    while size < width:
        step = min(size, width - size)
        n = len(h) - step
        lower = h[step:] < h[:n]
        h, p = np.where(lower, h[step:], h[:n]), np.where(lower, p[step:], p[:n])
        size += step
    return h, p


def window_keys(words: list[bytes], window: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window, the hash that judges it at this level and the place of its stretch."""
    if len(words) < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return _smallest(_stretch_hashes(words, length), window - length + 1)


def _keys(words: list[bytes], window: int, length: int, alive: np.ndarray | None = None) -> list[int]:
    """Signed keys of a text's stretches at a level, twice if the text itself repeats them."""
    h, p = window_keys(words, window, length)
    if alive is not None:
        h, p = h[alive], p[alive]
    places = np.unique(p, return_index=True)[1]
    value, count = np.unique(h[places], return_counts=True)
    return np.concatenate([value, value[count > 1]]).view(np.int64).tolist()


def _identity(words: list[bytes]) -> tuple[bytes, int, int]:
    """The words joined by single blanks, and 128 bits of their hash."""
    joined = b" ".join(words)
    halves = np.frombuffer(xxhash.xxh3_128_digest(joined), "<i8")
    return joined, int(halves[0]), int(halves[1])


def _alive(words: list[bytes], window: int, length: int, keys: list[int] | None) -> np.ndarray:
    """Which windows a level has left."""
    return np.isin(window_keys(words, window, length)[0], np.array(keys or [], np.int64).view(np.uint64))


def _marked(docs: DataFrame, key: str, text: str, window: int, length: int) -> DataFrame:
    """Per row: hash of its word sequence, number of words, digest of all words, and the first level's keys.

    What a task has seen twice needs no keys again: more places don't make a stretch more repeated.
    """
    def make():
        seen: dict[tuple[int, int], int] = {}

        def one(value):
            words = spaced_words(value)
            joined, s1, s2 = _identity(words)
            seen[s1, s2] = times = seen.get((s1, s2), 0) + 1
            keys = _keys(words, window, length) if times < 3 and len(words) >= window else []
            return s1, s2, len(words), hashlib.sha256(joined).hexdigest(), keys

        return lambda texts: list(zip(*map(one, texts)))

    return append(docs.select(named(key).alias("_key"), named(text).alias("_body")), "_body",
                  "s1 bigint, s2 bigint, n_words bigint, whole string, keys array<bigint>", make, ["_key"])


def _repeated(keyed: DataFrame, owner: str) -> DataFrame:
    """(owner, keys): for each owner the keys that occur more than once anywhere."""
    pairs = keyed.select(owner, F.explode("keys").alias("key"))
    often = pairs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return pairs.join(often, "key").groupBy(owner).agg(F.collect_set("key").alias("keys"))


def _filter(owners: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """A bitmap that has a bit for every ``s1``; its size is bounded, and too many texts only make it let more through."""
    bits = 1 << max(20, min(FILTER_MOST, max(1, FILTER_BITS * count)).bit_length())
    place = F.col("s1").bitwiseAND(bits - 1)
    rows = owners.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(s1 & 63 as int))")).alias("held")).collect()
    bitmap = np.zeros(bits // 64, np.int64)
    for row in rows:  # at most bits / 64
        bitmap[row["word"]] = row["held"]
    return bits, bitmap


def _candidates(docs: DataFrame, text: str, owners: DataFrame, classes: DataFrame) -> DataFrame:
    """One row per different word sequence that still has candidates: its words, the keys left and its copies."""
    spark = docs.sparkSession
    bits, bitmap = _filter(owners, owners.count())
    shared = spark.sparkContext.broadcast(bitmap)

    def make():
        held, seen = shared.value, set()

        def one(value):
            joined, s1, s2 = _identity(spaced_words(value))
            place = s1 & (bits - 1)
            if (s1, s2) in seen or not (int(held[place >> 6]) >> (place & 63)) & 1:
                return None, None, None
            seen.add((s1, s2))
            return s1, s2, joined.decode()

        return lambda texts: list(zip(*map(one, texts)))

    texts = append(docs.select(named(text).alias("_body")), "_body", "s1 bigint, s2 bigint, words string", make, []).where(
        "words is not null")
    found = texts.join(owners, "s1").dropDuplicates(["s1", "s2"]).join(classes, ["s1", "s2"])
    return settle(found.withColumn("_row", F.monotonically_increasing_id()), "candidates")


def _next_level(found: DataFrame, window: int, last: int, length: int) -> DataFrame:
    """The candidates with the keys of the next level that are repeated; the copies of a text count."""
    def make():
        def one(joined, keys, copies):
            words = joined.encode().split(b" ")
            new = _keys(words, window, length, _alive(words, window, last, keys))
            return new + (new if copies > 1 else [])

        return lambda texts, keys, copies: [[one(*row) for row in zip(texts, keys, copies)]]

    keyed = settle(append(found, "words", "keys array<bigint>", make, ["_row"], ["keys", "copies"]), "level")
    return settle(found.drop("keys").join(_repeated(keyed, "_row"), "_row"), "candidates")


def _single_windows(found: DataFrame, window: int, last: int) -> DataFrame:
    """(_row, singles): candidate windows whose words start nowhere else, by 128 bits of their hash."""
    def make():
        def one(joined, keys):
            raw = joined.encode()
            words = raw.split(b" ")
            ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
            places = np.flatnonzero(_alive(words, window, last, keys))
            digests = b"".join(xxhash.xxh3_128_digest(raw[ends[i - 1] + 1 if i else 0:ends[i + window - 1]]) for i in places)
            return np.frombuffer(digests, "<i8").reshape(-1, 2), places

        def work(texts, keys):
            rows = [one(*row) for row in zip(texts, keys)]
            halves, places = (np.concatenate([r[i] for r in rows]) for i in range(2))
            offsets = np.cumsum([0, *(len(r[1]) for r in rows)], dtype=np.int32)
            items = pa.StructArray.from_arrays([halves[:, 0], halves[:, 1], places], names=["h1", "h2", "at"])
            return [pa.ListArray.from_arrays(offsets, items)]

        return work

    windows = append(found, "words", "_windows array<struct<h1:bigint,h2:bigint,at:bigint>>", make, ["_row", "copies"], ["keys"])
    counted = windows.select("_row", "copies", F.inline("_windows")).groupBy("h1", "h2").agg(
        F.sum("copies").alias("n"), F.min("_row").alias("_row"), F.min("at").alias("at"))
    return counted.where("n = 1").groupBy("_row").agg(F.collect_list("at").alias("singles"))


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: its key, n_words, n_removed, kept_sha256, and ``kept`` as far as words were removed (else null).

    A word goes if some window of ``window`` consecutive words around it has the same words as a window starting
    anywhere else, in the same text or another one; windows are judged on the input. ``kept_sha256`` is the digest of
    the kept words joined by one blank. Null and empty texts have no words; texts shorter than a window lose none; a
    text with an equal copy loses all. Repeated rows stay and count as copies. An empty table gives an empty result.
    """
    lengths = levels(window)
    marked = settle(_marked(docs, key, text, window, lengths[0]), "marked")
    classes = marked.groupBy("s1", "s2").agg(F.count("*").alias("copies"))
    if len(lengths) > 1:
        owners = settle(_repeated(marked, "s1"), "owners")
    else:  # the window itself is the first level: all windows are candidates
        owners = settle(marked.where(F.size("keys") > 0).groupBy("s1").agg(F.flatten(F.collect_set("keys")).alias("keys")), "owners")
    found = _candidates(docs, text, owners, classes)
    for last, length in zip(lengths, lengths[1:-1]):
        found = _next_level(found, window, last, length)
    last = lengths[-2] if len(lengths) > 1 else window
    singles = _single_windows(found, window, last)

    def make():
        def one(joined, keys, alone):
            words = joined.encode().split(b" ")
            hit = _alive(words, window, last, keys)
            hit[np.array(alone or [], np.int64)] = False
            edges = np.zeros(len(words) + 1, np.int64)
            edges[:len(hit)] += hit
            edges[window:window + len(hit)] -= hit
            removed = np.cumsum(edges[:-1]) > 0
            kept = b" ".join(w for w, gone in zip(words, removed.tolist()) if not gone)
            return int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()

        return lambda texts, keys, alone: list(zip(*[one(*row) for row in zip(texts, keys, alone)]))

    judged = append(found.join(singles, "_row", "left"), "words", "n_removed bigint, kept_sha256 string, kept string",
                    make, ["s1", "s2"], ["keys", "singles"]).where("n_removed > 0")
    return marked.join(judged, ["s1", "s2"], "left").select(
        F.col("_key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept")
