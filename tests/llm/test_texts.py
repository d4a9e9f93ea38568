"""License scan, language, substrings and decontamination against brute force, with the odd inputs of each."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fleetworks.llm import decontaminate, language, licenses, substrings

SCHEMA = "doc_id bigint, text string, lang string, n_words string, SCORE double"
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "clash", 0.5) for i, t in enumerate(texts)], SCHEMA)


def prose(n, words=400, seed=3, size=60):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(size)}" for _ in range(rng.randrange(1, words))) for _ in range(n)]


# License scan


def places(text):
    words = LETTERED.findall(lowered(text))
    found = []
    for phrase, label in licenses.BASE_PHRASES.items():
        wanted = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(wanted)] == wanted]
    return len(words), found


def test_licenses_match_brute_force(spark):
    texts = [
        None, "", " \t\n", "Released UNDER the MIT-License.", "cc by nc cc by nc; CC-BY-NC 4.0", "Apache License, Version 2.0",
        "undér the mit license", "under the mit licenses", "cc by\nnc " * 3000, "x" * 100_000,
        "under the mit license under the mit license", "Under the MIT license", "Under the MIT license",
    ]
    rows = licenses.scan_licenses(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r["lang"] for r in rows] == ["en"] * len(texts)
    for text, row in zip(texts, rows):
        n, found = places(text)
        starts = [s for s, _ in found]
        assert (row["n_words"], row["n_base"]) == (n, len(found)), text
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize("line, shown, permissive", [
    ("MIT OR GPL-2.0-only AND Apache-2.0", "(mit or (gpl-2.0-only and apache-2.0))", True),
    ("(MIT OR GPL-2.0-only) AND GPL-3.0-only", "((mit or gpl-2.0-only) and gpl-3.0-only)", False),
    ("GPL-2.0-only WITH Classpath-exception-2.0 or ISC", "((gpl-2.0-only with classpath-exception-2.0) or isc)", True),
    ("MIT and the rest of the line", "mit", True),
    ("MIT.\nApache-2.0", "mit", True),
    ("(MIT OR", None, None),
    ("whatever", None, None),
    ("LicenseRef-mine", "licenseref-mine", None),
])
def test_expressions(line, shown, permissive):
    found = licenses.Scanner(licenses.BASE_PHRASES, {}).scan(f"// SPDX-License-Identifier: {line}")
    assert found[-2] == ([shown] if shown else []) and found[-1] == permissive


def test_licenses_of_nothing(spark):
    assert licenses.scan_licenses(docs(spark, ["x"]).where("false")).count() == 0


# Language


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(5)
    net = language.Network.fresh(["a", "b", "c"])
    net = language.Network(net.languages, [p.astype(float) for p in net.parts])
    x, y = rng.integers(0, 256, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    grads, _ = net.gradients(x, y)
    for part, grad in zip(net.parts, grads):
        for at in [np.unravel_index(np.abs(grad).argmax(), grad.shape), tuple(0 for _ in grad.shape)]:
            kept = part[at]
            part[at] = kept + 1e-5
            up = net.gradients(x, y)[1]
            part[at] = kept - 1e-5
            down = net.gradients(x, y)[1]
            part[at] = kept
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4


def test_language_held_out_accuracy(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(data, language.fit(data)).where(language.held_out())
    right, n = found.selectExpr("sum(int(lang_pred = lang))", "count(*)").first()
    assert n > 300 and right / n > 0.95


def test_held_out_rows_are_not_learned(spark):
    data = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    keys = [r["k"] for r in language.learning_sample(data, "doc_id", "text", "lang").collect()]
    assert keys and all(zlib.crc32(str(k).encode()) % 3 != 1 for k in keys)


def test_language_of_odd_texts(spark):
    data = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    network = language.fit(data)
    odd = [None, "", "123 %% 45", "ß", "The and of that " * 20_000, "The and of that", "The and of that"]
    rows = language.identify(docs(spark, odd), network).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows[:3]] == ["und"] * 3 and [r["score"] for r in rows[:3]] == [0.0] * 3
    assert {r["lang_pred"] for r in rows[3:]} <= set(network.languages) and rows[5]["score"] == rows[6]["score"]
    assert all(0 < r["score"] <= 1 for r in rows[3:])
    assert "SCORE" not in rows[0].asDict() and rows[0]["n_words"] == "clash"
    none = language.fit(docs(spark, ["abc"], lang=None))
    assert [r["lang_pred"] for r in language.identify(docs(spark, ["abc", None]), none).collect()] == ["und"] * 2
    assert language.identify(docs(spark, ["x"]).where("false"), network).count() == 0


# Substrings


def brute_kept(texts, window):
    lists = [SPACED.findall(t or "") for t in texts]
    count = {}
    for words in lists:
        for i in range(len(words) - window + 1):
            count[tuple(words[i:i + window])] = count.get(tuple(words[i:i + window]), 0) + 1
    out = []
    for words in lists:
        gone = set()
        for i in range(len(words) - window + 1):
            if count[tuple(words[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [5, 17, 35, 70])
def test_substrings_match_brute_force(spark, window):
    base = prose(12, 300, seed=window)
    shared = " ".join(f"s{i}" for i in range(window + 30))
    texts = base + [
        None, "", " \t", "a b c", base[0], base[0].replace(" ", "\n\t"), f"x {shared} y", f"{shared} z", f"q {shared}",
        " ".join(shared.split()[:window]) + " tail", "same " * 400, " ".join(f"u{i}" for i in range(3000)),
        base[1] + " extra words", "É " + shared + " " + shared, base[2], base[2],
    ]
    rows = substrings.remove_repeated(docs(spark, texts), window=window).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows] == brute_kept(texts, window)
    for text, r in zip(texts, rows):
        if r["kept"] is not None:
            assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_substrings_small_vocabulary(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = substrings.remove_repeated(docs(spark, texts), window=35).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows] == brute_kept(texts, 35)


def test_substrings_of_nothing(spark):
    assert substrings.remove_repeated(docs(spark, ["x"]).where("false")).count() == 0


# Decontamination


def brute_hits(texts, items, window):
    tests = []
    for name, text in items:
        words = LETTERED.findall(lowered(text))
        n = min(window, len(words))
        tests += [(str(name), words[i:i + n]) for i in range(len(words) - n + 1 if n else 0)]
    out = []
    for text in texts:
        words, hit, names = LETTERED.findall(lowered(text)), set(), set()
        for name, wanted in tests:
            for i in range(len(words) - len(wanted) + 1):
                if words[i:i + len(wanted)] == wanted:
                    hit |= set(range(i, i + len(wanted)))
                    names.add(name)
        out.append((len(words), len(hit), len(names), ",".join(sorted(names)), bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [100_000, 25])
def test_decontamination_matches_brute_force(spark, block_words):
    items = [(1, " ".join(f"i{k}" for k in range(23))), (2, "Only three words"), (10, "one"), (3, None), (4, ""), (5, "?!"),
             (6, " ".join(f"i{k}" for k in range(8, 30))), (7, "a b a b a b a b a b a"), (7, "a b a b a b a b a b a")]
    texts = prose(8, 40) + [
        None, "", "...", "x " + items[0][1].upper() + " y " + items[6][1], "only, THREE\nwords only three words", "One",
        "a b " * 30, "i0 i1 i2 i3 i4 i5 i6 i7 i8", " ".join(f"i{k}" for k in range(10)), "bone one", "z " * 30_000,
        "only three words", "only three words"]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.mark(docs(spark, texts), table, block_words=block_words).orderBy("doc_id").collect()
    got = [(r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]) for r in rows]
    assert got == brute_hits(texts, items, 10)
    assert rows[0]["SCORE"] == 0.5
    clean = decontaminate.clean(docs(spark, texts), table, block_words=block_words)
    assert clean.columns == docs(spark, []).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i, g in enumerate(got) if not g[-1]]


def test_decontamination_without_items_or_documents(spark):
    table = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    row = decontaminate.mark(docs(spark, ["a b c"]), table.where("false")).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (3, 0, False)
    assert decontaminate.mark(docs(spark, ["x"]).where("false"), table).count() == 0
