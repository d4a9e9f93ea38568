"""The pipeline's language stage: what the network's score decides, and what stays if it learned nothing."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetworks.llm import language

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_texts_in_no_learned_language_go(spark, tmp_path):
    rng = random.Random(2)
    junk = [(-1 - i, "".join(rng.choice("абвгдежзийклмнопрстуфхцчшщыьэюя     ") for _ in range(1000)), None, None, 0) for i in range(25)]
    junk += [(-101 - i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(1500)), None, None, 0) for i in range(25)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    n = docs.where(F.col("text").rlike(r"\p{L}")).count()
    docs.unionByName(spark.createDataFrame(junk, SCHEMA)).write.parquet(f"{tmp_path}/docs")
    kept = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    good, bad = kept.selectExpr("sum(int(doc_id >= 0))", "sum(int(doc_id < 0))").first()
    assert good >= 0.995 * n and (bad or 0) <= 10


def test_all_texts_stay_if_nothing_was_learned(spark):
    rows = [(0, "Some words of text", None, None, 0), (1, "ß", None, None, 0), (2, "12 %", None, None, 0), (3, None, None, None, 0),
            (4, "", None, None, 0)]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


def test_a_hot_key_leaves_the_sample_whole(spark):
    keys = F.when(F.col("id") < 100_000, 7).otherwise(F.col("id")).alias("doc_id")
    texts = F.when(F.col("id") < 100_000, "the same text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text")
    docs = spark.range(101_000).select(keys, texts, F.lit("en").alias("lang"))
    rows = language.learning_sample(docs, "doc_id", "text", "lang").collect()
    assert len(rows) == language.SAMPLE_ROWS and sum(r["k"] == 7 for r in rows) <= 1


def many_languages(count, rows, words, seed):
    """Invented languages: each has words of its own from a common alphabet, with its own letters more frequent."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        letters = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)] + list("aeiou")
        lexicon = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(150)]
        out += [(f"l{n}", " ".join(rng.choice(lexicon) for _ in range(words))) for _ in range(rows)]
    rng.shuffle(out)
    return [(i, text, lang, "s", len(text)) for i, (lang, text) in enumerate(out)]


@pytest.mark.parametrize("count", [4, 24])
def test_clean_documents_stay_however_many_languages(spark, count):
    docs = spark.createDataFrame(many_languages(count, 150, 100, count), SCHEMA).repartition(4).cache()
    kept = corpus_pipeline.identify_language(spark, docs, "")
    unseen, stay = (df.where(language.held_out()).count() for df in (docs, kept))
    assert stay >= 0.99 * unseen and kept.count() >= 0.99 * docs.count()


def test_positions_are_those_of_a_plain_loop():
    """Padding and ragged windows change nothing: every byte is read in its own window, in both directions."""
    network = language.Network.fresh(["a", "b", "c"])
    rng = np.random.default_rng(1)
    network.parts[:] = [rng.normal(0, 0.5, p.shape).astype(np.float32) for p in network.parts]
    network = language.Network(network.languages, network.parts)
    ahead, back = network.parts[0:3], network.parts[3:6]
    weights = network.parts[6:]
    for text in ("x", "some text", "é" * 100, "word " * 30, "a" * language.WINDOW, "a" * (language.WINDOW + 1)):
        raw, total = text.encode(), np.zeros(3)
        for at in range(0, len(raw), language.WINDOW):
            piece = raw[at:at + language.WINDOW].ljust(language.WINDOW, b" ")
            states = []
            for (byte, gate, candidate), order in ((ahead, range(language.WINDOW)), (back, range(language.WINDOW - 1, -1, -1))):
                h, found = np.zeros(language.STATE), {}
                for t in order:
                    a = byte[:, piece[t]]
                    u = gate @ h + a[:language.STATE]
                    g = 0.5 + 0.5 * u / (1 + np.abs(u))
                    c = candidate @ (g * h) + a[language.STATE:]
                    h = h + g * (c / (1 + np.abs(c)) - h)
                    found[t] = h
                states.append(found)
            for t in range(min(language.WINDOW, len(raw) - at)):
                z = weights[0] @ np.concatenate([states[0][t], states[1][t]]) + weights[1].ravel()
                e = np.exp(z - z.max())
                total += e / e.sum()
        pooled = total / len(raw)
        lang, score = network.read([text])
        assert lang == [network.languages[int(pooled.argmax())]] and abs(score[0] - pooled.max()) < 1e-4


def test_every_labelled_row_is_learned_from_and_judged_by(spark):
    """More rows than the sample takes: another text in any of them changes the network, and all have a say in the thresholds."""
    rows = many_languages(2, 2 * language.SAMPLE_ROWS, 30, 5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2, "doc_id").cache()
    sampled = {r["k"] for r in language.learning_sample(docs, "doc_id", "text", "lang").collect()}
    free = docs.where(~language.held_out()).where(~F.col("doc_id").isin(*sampled)).first()
    start = language.fit(docs)
    learned = language.learn_all(docs, start)
    changed = docs.withColumn("text", F.when(F.col("doc_id") == free["doc_id"], F.lit("q" * 900)).otherwise(F.col("text")))
    other = language.learn_all(changed, start)
    assert any((a != b).any() for a, b in zip(start.parts, learned.parts))
    assert any(np.abs(a - b).max() > 1e-5 for a, b in zip(learned.parts, other.parts))
    scored = language.identify(docs, learned)
    low = scored.withColumn("score", F.when(F.col("doc_id") % 20 == 0, 0.0).otherwise(F.col("score")))
    assert set(language.usual_scores(low, learned).values()) == {0.0}


def test_held_out_rows_change_nothing_in_the_pass_over_all_rows(spark):
    docs = spark.createDataFrame(many_languages(2, 60, 30, 6), SCHEMA).coalesce(1)
    start = language.fit(docs)
    changed = docs.withColumn("text", F.when(language.held_out(), F.lit("zzz")).otherwise(F.col("text")))
    for a, b in zip(language.learn_all(docs, start).parts, language.learn_all(changed, start).parts):
        assert (a == b).all()
