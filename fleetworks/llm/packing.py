"""Packing by powers of two: pieces of binary lengths, each a sequence of its own, equal lengths side by side."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fleetworks.llm.frames import append, named
from fleetworks.session import settle

LONGEST = 1024
END_ID = 0
# Fixed value: how the vocabulary's tokens are bounded.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Anything beyond Latin, Greek and Cyrillic letters and common punctuation.
_UNUSUAL = "[^\x00-\u0377\u0400-\u052f\u2010-\u2027]"

#: The faster reader's stack ends at about a million blanks in a row.
_BLANKS = re.compile(r"\s{1000}")


def vocabulary() -> str:
    """The public byte-level vocabulary, found on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts, as unsigned 32-bit little-endian bytes, by one vocabulary file of tokenizers.

    A faster reader of the same merges takes the texts whose characters every Unicode version classes alike and that
    hold no special token and no long run of blanks; the others go to tokenizers itself. Both give the same ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread per task
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.odd = re.compile("|".join([_UNUSUAL, *map(re.escape, added)]))
        letters = _byte_of()
        ranks = {bytes(letters[c] for c in word): rank
                 for word, rank in self.tokenizer.get_vocab(with_added_tokens=False).items() if word not in added}
        self.plain = tiktoken.Encoding("plain", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.odd.search(text) or _BLANKS.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.plain.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)  # built once in a worker process
def encoder_for(path: str) -> Encoder:
    return Encoder(path)


def binary_pieces(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of pieces that cover n ids: as many of the longest as fit, then the powers of two of the rest."""
    pieces = [(at, longest) for at in range(0, n - longest + 1, longest)]
    at, size = len(pieces) * longest, longest
    while size := size >> 1:
        if (n - at) & size:
            pieces.append((at, size))
            at += size
    return pieces


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST, end_id: int = END_ID,
         with_ids: bool = False, tokenizer=vocabulary) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if asked for.

    ``longest`` is a power of two. A text's ids are followed by ``end_id``, so null and empty texts make one piece of
    one id. Every sequence is one piece and a power of two long, so none needs padding or crosses documents. Sequences
    are numbered from 0, longest first and equal lengths together. Repeated rows keep pieces of their own. The pieces
    are written once, and numbering them moves none. An empty table gives an empty result.
    ``tokenizer`` returns the vocabulary's path on the machine where it is called.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    ending = end_id.to_bytes(4, "little")

    def make():
        encoder, part, reached = encoder_for(tokenizer()), TaskContext.get().partitionId(), Counter()

        def work(texts):
            ids = [encoder.encode(t) + ending for t in texts]
            cuts = [binary_pieces(len(i) // 4, longest) for i in ids]
            start, length, crc, place = [], [], [], []
            for own, pieces in zip(ids, cuts):
                for at, size in pieces:
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own[4 * at:4 * (at + size)]))
                    place.append(reached[size])
                    reached[size] += 1
            columns = {"start": start, "length": length, "ids_crc32": crc, "place": place}
            arrays = [pa.array(c, pa.int64()) for c in columns.values()]
            if with_ids:
                ends = np.cumsum([0, *length], dtype=np.int32)
                arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), "<i4"))))
            rows = pa.StructArray.from_arrays(arrays, names=[*columns, *["ids"] * with_ids])
            offsets = np.cumsum([0, *map(len, cuts)], dtype=np.int32)
            return [len(i) // 4 for i in ids], [part] * len(texts), pa.ListArray.from_arrays(offsets, rows)

        return work

    fields = "start:bigint,length:bigint,ids_crc32:bigint,place:bigint" + ",ids:array<int>" * with_ids
    cut = append(docs.select(named(key).alias("_key"), named(text).alias("_body")), "_body",
                 f"doc_tokens bigint, _part int, _pieces array<struct<{fields}>>", make, ["_key"])
    pieces = settle(cut.select("_key", "doc_tokens", "_part", F.inline("_pieces")), "pieces")
    # a task has numbered its pieces of each length; what the tasks before it hold, and longer pieces, come first
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)  # one row per length
    lengths = counts.groupBy("length").agg(F.sum("n").alias("all")).select(
        "length", F.coalesce(F.sum("all").over(longer), F.lit(0)).alias("longer"))
    # written, so that its small size is known before the pieces would be sent to meet it
    first = settle(counts.select("length", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).join(
        lengths, "length"), "first-pieces")
    return pieces.join(first, ["length", "_part"]).select(
        F.col("_key").alias(key), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("longer") + F.col("before") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"), *["ids"] * with_ids)
