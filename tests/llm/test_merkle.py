"""Trees, proofs and verification against plain hashing."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetworks.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, tree int, `a.b` string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def grow(level):
    """The last node, and for each first one its siblings as (left, right) a level."""
    paths, owners = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [range(at, min(at + 3, len(level))) for at in range(0, len(level), 3)]
        for run in runs:
            for i in run:
                for own in owners[i]:
                    paths[own].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        owners = [[o for i in run for o in owners[i]] for run in runs]
        level = [H("".join(level[i] for i in run)) for run in runs]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for row in rows:  # doc_id, source, lang, n_chars, text
        groups[row[1]].append(((row[0] is not None, row[0] or 0), leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    grown = [grow([h for _, h, _ in sorted(groups[s], key=lambda r: r[:2])]) for s in order]
    root, above = grow([top for top, _ in grown])
    out = []
    for source, (top, paths), more in zip(order, grown, above):
        for (_, own, row), path in zip(sorted(groups[source], key=lambda r: r[:2]), paths):
            key, text = row[0], row[4]
            fold = leaf((*row[:4], text.replace("\n", "") if text and key is not None and zlib.crc32(str(key).encode()) % 2 == 0 else text))
            for a, b in path + more:
                fold = H(a + fold + b)
            out.append((key, own, top, root, H("".join(a + b for a, b in path + more)), fold, fold == root))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(k, t, la, s, n, "clash", 5, "dot") for k, s, la, n, t in rows], SCHEMA).repartition(3)
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.verified(merkle.manifest(docs, changed={"text": cut}), "changed_leaf").withColumn(
        "proof", merkle.proof_digest(F.col("siblings")))
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


def made(seed, sizes):
    rng = random.Random(seed)
    return [(rng.randrange(10 ** 6), source, rng.choice(["en", "de", None]), rng.choice([None, 3, 70]),
             rng.choice([None, "", "one\ntwo\n", "é\n漢 字", "plain words"]) or f"t{rng.random()}\n")
            for source, n in sizes.items() for _ in range(n)]


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 4}, {"a": 1, "b": 1}, {"a": 1, "b": 2, "c": 3, "d": 30}, {None: 5, "": 1, "é": 10, "z": 9, "Z": 28},
    {f"s{i}": 1 + i % 4 for i in range(30)}, {"hot": 260, **{f"s{i}": 1 for i in range(11)}}])
def test_proofs_of_any_shape(spark, sizes):
    rows = made(3, sizes)
    assert found(spark, rows) == brute(rows)


def test_ties_repeated_rows_nulls_and_long_texts(spark):
    rows = made(4, {"a": 10, None: 3})
    rows += rows[:4] + [(7, "a", None, None, None), (7, "a", None, None, "x\n"), (7, "a", None, None, "x\n"), (None, "a", "en", 1, "y\n"),
                        (None, None, None, None, None), (8, "b", "", 0, ""), (9, "b", "-", 2, "long\n" * 100_000)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    out = merkle.verified(merkle.manifest(spark.createDataFrame([], SCHEMA)))
    assert out.collect() == [] and out.columns[:4] == ["doc_id", "leaf", "subroot", "root"]


def test_a_proof_holds_for_its_row_alone(spark):
    docs = spark.createDataFrame([(k, t, la, s, n, "", 1, "") for k, s, la, n, t in made(5, {"a": 20, "b": 7})], SCHEMA)
    rows = merkle.manifest(docs)
    assert all(r["verified"] for r in merkle.verified(rows).collect())
    wrong = rows.withColumn("leaf", F.reverse("leaf"))
    assert not any(r["verified"] for r in merkle.verified(wrong).collect())
