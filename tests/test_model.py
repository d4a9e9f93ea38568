from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fleetworks import constants as C
from fleetworks.plans import model
from tests.conftest import tuples


@pytest.fixture(scope="module")
def rows(spark):
    """Every engine_hours differs; a tenth is on the held-out day."""
    rng = random.Random(5)
    features = [(rng.choice([0.0] * 9 + [rng.random() * 50]), 0.0, 0.0, 0, 0, i + rng.random(), 3, 9999) for i in range(4000)]
    labelled = [(dt.date(2024, 1, 20 if i % 10 == 0 else 1), int(f[0] > 20 or (f[5] > 3000 and rng.random() < 0.5)), *f)
                for i, f in enumerate(features)]
    return spark.createDataFrame(labelled, "date_id date, label int, " + ", ".join(f"{c} double" for c in C.FEATURES[:3])
                                 + ", critical_count_7d long, critical_count_14d long, engine_hours double, machine_age_days int, days_since_last_maintenance int")


def test_training_passes_over_bins_that_weigh_as_much_as_the_rows(spark, rows, monkeypatch):
    seen, spread = [], model._spread
    monkeypatch.setattr(model, "_spread", lambda cells: seen.append(cells) or spread(cells))
    fitted, judged = model.train_and_evaluate(rows, 5, max_iter=3)
    n, weight, positives = seen[0].agg(F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
    train = rows.filter("date_id < '2024-01-10'")
    assert n < 1000 and weight == train.count() and positives == train.agg(F.sum("label")).first()[0]
    held_out = rows.filter("date_id > '2024-01-10'")
    assert sum(judged.confusion.values()) == held_out.count()
    assert sum(v for (label, _), v in judged.confusion.items() if label) == held_out.filter("label = 1").count()
    assert judged.auc > 0.9

    odd = rows.select("date_id", *C.FEATURES).limit(1)
    odd = rows.select("date_id", *C.FEATURES).unionByName(odd.withColumn("engine_hours", F.lit(math.nan))).unionByName(
        odd.withColumn("engine_hours", F.lit(math.inf))).unionByName(odd.withColumn("engine_hours", F.lit(-1e300)))
    inputs = model._inputs(odd)
    scored = fitted.transform(inputs).select((F.abs(
        vector_to_array("probability")[1] - model.compiled_probability(fitted)) < 1e-12).alias("same"))
    assert tuples(scored.distinct()) == [(True,)]


def test_edges_leave_room_beside_frequent_values(spark):
    many = spark.range(10_000).select(F.when(F.col("id") < 9_300, 0.0).otherwise(F.col("id").cast("double")).alias("a b"),
                                      (F.col("id") % 5).cast("double").alias("few"), F.lit(None).cast("double").alias("none"))
    mostly, few, none = model.bin_edges(many, ["a b", "few", "none"])
    assert len(mostly) <= model.MAX_BINS - 1 and mostly[0] == 0.0 and sum(e >= 9_300 for e in mostly) >= 25
    assert few == [0.0, 1.0, 2.0, 3.0, 4.0] and none == []


def test_confusion_counts_rows_unless_a_weight_says_how_many_they_stand_for(frame):
    judged = frame("label int, prediction double, weight double", [
        (1, 1.0, 3.0), (1, 1.0, 4.0), (0, 1.0, 2.0), (0, 0.0, 5.0), (None, 0.0, 1.0)])
    columns = ("label", "prediction", "n")
    assert tuples(model.confusion_counts(judged.drop("weight")), *columns) == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (None, 0, 1)]
    assert tuples(model.confusion_counts(judged), *columns) == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (None, 0, 1)]
    assert tuples(model.confusion_counts(judged, "weight"), *columns) == [(0, 0, 5), (0, 1, 2), (1, 1, 7), (None, 0, 1)]
