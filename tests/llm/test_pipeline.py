"""The corpus pipeline against brute force, stage by stage."""

from __future__ import annotations

import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from fleetworks.llm import surrogates  # noqa: E402
from tests.llm.test_records import brute_components, brute_print  # noqa: E402
from tests.llm.test_texts import brute_hits  # noqa: E402

ROOT = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def reached(spark, tmp_path_factory):
    """What each stage kept, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, ROOT).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_language_drops_only_texts_without_letters(reached):
    kept = {r["doc_id"] for r in reached[1]}
    assert kept == {r["doc_id"] for r in reached[0] if r["text"] and any(c.isalpha() for c in r["text"])}


def test_one_document_of_each_group_stays(reached):
    rows = sorted(reached[1], key=lambda r: r["doc_id"])
    roots = brute_components([brute_print(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in reached[2]) == [rows[i]["doc_id"] for i in sorted(set(roots))]


def test_contaminated_documents_go(spark, reached):
    items = [tuple(r) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute_hits([r["text"] for r in reached[2]], items, 10)
    assert {r["doc_id"] for r in reached[3]} == {r["doc_id"] for r, h in zip(reached[2], hits) if not h[-1]}


def test_personal_data_is_replaced_and_nothing_else(reached):
    after = {r["doc_id"]: r["text"] for r in reached[4]}
    assert len(after) == len(reached[3]) == len(reached[4])
    found = 0
    for r in reached[3]:
        mentions = surrogates.mentions(r["text"])
        found += len(mentions)
        if not mentions:
            assert after[r["doc_id"]] == r["text"]
        for a, b, _, _ in mentions:
            assert r["text"][a:b] not in after[r["doc_id"]]
    assert found


def test_packed_ids_are_the_kept_texts(reached):
    from tokenizers import Tokenizer

    from fleetworks.llm import packing

    tokenizer, ids = Tokenizer.from_file(packing.vocabulary()), defaultdict(list)
    for r in sorted(reached[5], key=lambda r: (r["doc_id"], r["start"])):
        ids[r["doc_id"]] += r["ids"]
    for r in reached[4]:
        assert ids.pop(r["doc_id"]) == tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
    assert not ids


def test_stages_take_odd_documents(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _fp string, `x.y` string"
    rows = [(1, None, None, None, None, 1.0, "a", "b"), (2, "", None, "s", 0, None, None, None),
            (None, "Some words of text", "en", None, 3, 2.0, "c", "d"), (4, "Some other words by me@mail.example.org", "en", "s", 1, 0.0, "", ""),
            (4, "Some other words by me@mail.example.org", "en", "s", 1, 0.0, "", ""), (5, "word " * 30_000, "de", "s", 1, 0.0, "", "")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, ROOT)
            if name != "packing":
                assert out.columns == docs.columns
            got = out.collect()
            if name in ("personal_data", "decontamination"):
                assert len(got) == n
            if name == "language":
                assert len(got) == max(0, n - 2)


def test_run_returns_the_last_stage(spark, reached):
    rows = corpus_pipeline.run(spark, ROOT).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["sequence_id"])
    assert sorted(map(key, rows)) == sorted(map(key, reached[5]))
