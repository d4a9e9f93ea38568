"""Byte-level BPE by a rank queue: encoding texts into token ids, and ids back into bytes.

A pre-token starts as a linked list of its bytes. Each neighbouring pair that is a token waits in the bucket of its
rank. A hierarchical bitmap marks the buckets that hold something, so that finding the lowest rank takes one
find-first-set per level, however long the pre-token is. A merge changes the two pairs beside it; what they waited for
before is left in its bucket and skipped when it comes up.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from fleetworks.llm.frames import append, without

#: Bits of one bitmap word, a power of two.
WORD = 256
#: Pre-tokens whose ids a task remembers: those of at most so many characters, and so many of them.
SHORT, REMEMBERED = 48, 400_000
#: Texts beyond so many characters hand over their pre-tokens one by one instead of as a list.
LONG_TEXT = 1 << 20
#: Rows whose ids are decoded at once.
LANES = 64
_NONE = -1
_SHIFT, _MASK, _BITS = WORD.bit_length() - 1, WORD - 1, [1 << i for i in range(WORD)]


def vocabulary() -> str:
    """The public rank file, found on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    """How the rank file's texts are split before merging."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Positions waiting under ranks; the lowest rank comes first, and the leftmost position of a rank.

    A rank is a bit of one of ``words``, and a word that isn't zero a bit of ``top``. A bucket is its only position, or
    a heap of several.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, int | list[int]] = {}
        self.words = [0] * -(-ranks // WORD)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = position
            at = rank >> _SHIFT
            self.words[at] |= _BITS[rank & _MASK]
            self.top |= 1 << at
        elif type(bucket) is int:
            self.buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
        else:
            heappush(bucket, position)

    def lowest(self) -> int:
        """The lowest rank with a position, or -1: one find-first-set a level, from the top."""
        top = self.top
        if not top:
            return _NONE
        at = (top & -top).bit_length() - 1
        word = self.words[at]
        return (at << _SHIFT) + (word & -word).bit_length() - 1

    def pop(self, rank: int) -> int:
        bucket = self.buckets[rank]
        if type(bucket) is list:
            position = heappop(bucket)
            if len(bucket) == 1:
                self.buckets[rank] = bucket[0]
            return position
        del self.buckets[rank]
        at = rank >> _SHIFT
        self.words[at] ^= _BITS[rank & _MASK]
        if not self.words[at]:
            self.top ^= 1 << at
        return bucket


class _Known(dict):
    """Packed ids of pre-tokens met before.

    When it is full it becomes the older half, and starts anew with what comes up of it, so that frequent pre-tokens
    stay whatever else the texts hold. Long pre-tokens are encoded each time.
    """

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder, self.older = coder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.coder.merge(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Coder:
    """Token ids of whole texts as unsigned 32-bit little-endian bytes, and the bytes of such ids.

    ``ranks`` must hold every single byte, as byte-level vocabularies do.
    """

    def __init__(self, ranks: dict[bytes, int], split: str):
        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.split = regex.compile(split)
        self.known = _Known(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: again and again the pair of the lowest rank, leftmost first, becomes one token."""
        ranks, queue, n = self.ranks, self.queue, len(piece)
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        # a token is known by where it starts, and ends where the next one starts
        before, after = list(range(-1, n)), list(range(1, n + 2))
        awaited = [_NONE] * n  # the rank under which the pair that starts here waits
        rank_of, push, buckets, words = ranks.get, queue.push, queue.buckets, queue.words
        for i in range(n - 1):
            rank = rank_of(piece[i:i + 2])
            if rank is not None:
                awaited[i] = rank
                push(rank, i)
        while top := queue.top:
            # RankQueue.lowest and pop, written out: this is where the time goes
            at_word = (top & -top).bit_length() - 1
            word = words[at_word]
            rank = (at_word << _SHIFT) + (word & -word).bit_length() - 1
            at = buckets[rank]
            if type(at) is list:
                at = queue.pop(rank)
            else:
                del buckets[rank]
                words[at_word] = word = word & (word - 1)
                if not word:
                    queue.top = top & (top - 1)
            if awaited[at] != rank:
                continue  # stale: one of the two has become part of another token
            gone = after[at]
            right = after[at] = after[gone]
            awaited[gone] = awaited[at] = _NONE
            before[right] = at
            if right < n:
                rank = rank_of(piece[at:after[right]])
                if rank is not None:
                    awaited[at] = rank
                    push(rank, at)
            left = before[at]
            if left >= 0:
                rank = rank_of(piece[left:right])
                if rank is None:
                    awaited[left] = _NONE
                else:
                    awaited[left] = rank
                    push(rank, left)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at:after[at]]])
            at = after[at]
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) > LONG_TEXT:
            return b"".join(self.known[m.group()] for m in self.split.finditer(text))
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")]) if ids else b""


@lru_cache(maxsize=1)  # built once in a worker process
def coder_for(path: str, split: str) -> Coder:
    return Coder(read_ranks(path), split)


def encode(docs: DataFrame, text: str = "text", keep=None, with_ids: bool = False, tokenizer=vocabulary,
           splitter=pattern) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of the whole text, and ``ids`` (array<int>) if asked for.

    The digests are lowercase hex: of the ids as little-endian unsigned 32-bit integers, and of the bytes that decoding
    these ids gives. Null and empty texts have no ids, so both digests are those of nothing. Every match of the split
    pattern is encoded by itself, of any length; special tokens are ordinary text. Repeated rows stay, clashing columns
    are replaced, an empty table gives an empty result. ``tokenizer`` and ``splitter`` return the rank file's path and
    the pattern on the machine where they are called.
    """
    def make():
        coder = coder_for(tokenizer(), splitter())

        def work(texts):
            ids = [coder.encode(t) for t in texts]
            columns = [[len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids],
                       [hashlib.sha256(coder.decode(i)).hexdigest() for i in ids]]
            return columns + [pa.array([memoryview(i).cast("I").tolist() if i else [] for i in ids], pa.list_(pa.int32()))] * with_ids

        return work

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return append(docs, text, added, make, keep)


def decode(frame: DataFrame, ids: str = "ids", tokenizer=vocabulary, splitter=pattern) -> DataFrame:
    """``frame`` with ``decoded``, the bytes of an array of ids. Null gives null, no ids give no bytes.

    Ids that the vocabulary doesn't have fail, and so do null ids inside an array. Repeated rows stay, a clashing column
    is replaced.
    """
    source = without(frame, ["decoded"])
    at, inside = source.columns.index(ids), source.toDF(*[f"_p{i}" for i in range(len(source.columns))])
    out = T.StructType([*inside.schema.fields, T.StructField("_decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(tokenizer(), splitter())
        for whole in batches:
            for start in range(0, whole.num_rows, LANES):
                batch = whole.slice(start, LANES)
                bytes_ = [None if x is None else coder.decode(struct.pack(f"<{len(x)}I", *x)) for x in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bytes_, pa.binary())], names=out.names)

    return inside.mapInArrow(run, out).toDF(*source.columns, "decoded")
