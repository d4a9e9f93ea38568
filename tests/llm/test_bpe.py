"""The rank queue against tiktoken and against merging by hand."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from fleetworks.llm import bpe
from fleetworks.llm.queries import op13_bpe

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(bpe.vocabulary())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def by_hand(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    if piece in ranks:
        return [ranks[piece]]
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        at = min(found)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def expected(text, library):
    ids = library.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def odd_texts():
    rng = random.Random(7)
    letters = "abcdeéßжя中文字ا́٣१ \n\t  ' 　!?.-_🙂\U0001F468‍"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    return [None, "", " ", "a", "<|endoftext|>", "it's WE'LL x" * 3, "\x00\x01\x7f", *texts]


def test_whole_table_matches_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    got = op13_bpe(spark, DATA).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(docs[r["doc_id"]], library)


def test_odd_texts_repeated_rows_and_clashing_columns(spark, library):
    texts = odd_texts() * 2
    rows = spark.createDataFrame([(i, t, "clash", "dot") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, ids_sha256 string, `a.b` string")
    out = bpe.decode(bpe.encode(rows, with_ids=True))
    assert out.columns == ["doc_id", "text", "a.b", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    got = sorted(out.collect(), key=lambda r: r["doc_id"])
    for r, t in zip(got, texts, strict=True):
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(t, library)
        assert r["ids"] == library.encode_ordinary(t or "") and bytes(r["decoded"]) == (t or "").encode()


def test_empty_table_and_null_ids(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "k int, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(ids).orderBy("k").collect()] == [None, b"", b'!"']


def test_very_long_pre_tokens(ranks, library, monkeypatch):
    coder, rng = bpe.Coder(ranks, bpe.pattern()), random.Random(3)
    for text in ("ab" * 30_000, "".join(rng.choice("abcde") for _ in range(40_000)), "=" * 70_001, " " * 20_000 + "x", "漢字" * 9_000):
        assert coder.encode(text) == struct.pack(f"<{len(i := library.encode_ordinary(text))}I", *i)
    million = "\n" * 1_000_001  # the library's own stack ends here
    assert coder.decode(coder.encode(million)) == million.encode()
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    assert coder.encode("some words of text") == struct.pack("<4I", *library.encode_ordinary("some words of text"))


def test_any_order_of_ranks():
    """Tables in which a longer token may have a lower rank than its parts."""
    rng = random.Random(11)
    for _ in range(200):
        tokens = {bytes([b]) for b in b"abc"}
        while len(tokens) < 40:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 7))))
        order = rng.sample(sorted(tokens), len(tokens))
        table = {t: 3 * i for i, t in enumerate(order)}
        coder = bpe.Coder(table, r"\S+")
        for _ in range(10):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 60)))
            assert coder.merge(piece) == by_hand(piece, table)
        assert coder.queue.lowest() == -1 and not coder.queue.buckets


@pytest.mark.parametrize("ranks", [1, 64, 65, 5000, 300_000])
def test_queue_gives_lowest_rank_and_leftmost_position(ranks):
    rng, queue, held = random.Random(5), bpe.RankQueue(ranks), []
    for _ in range(3000):
        if held and rng.random() < 0.45:
            rank = queue.lowest()
            assert (rank, queue.pop(rank)) == held.pop(held.index(min(held)))
        else:
            held.append((rng.randrange(ranks), rng.randrange(10_000)))
            queue.push(*held[-1])
    assert queue.lowest() == (min(held)[0] if held else -1)
