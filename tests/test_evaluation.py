from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fleetworks.operators import running_totals
from fleetworks.plans import evaluation, trees
from tests.conftest import tuples


@pytest.mark.parametrize("levels", [1, 3, 40, 10_000])
def test_area_precision_and_recall_with_ties(spark, frame, levels):
    rng = random.Random(levels)
    rows = [(rng.randrange(levels) / levels, int(rng.random() < 0.3)) for _ in range(400)]
    curve = evaluation.threshold_curve(frame("score double, label int", [*rows, (None, 1), (0.5, None)]), "score")
    positives, negatives = ([s for s, y in rows if y == v] for v in (1, 0))
    wanted = sum((p > n) + (p == n) / 2 for p in positives for n in negatives) / (len(positives) * len(negatives))
    area = evaluation.area_under_curve(curve).first()
    assert area["auc"] == pytest.approx(wanted, abs=1e-12) and (area["positives"], area["negatives"]) == (len(positives), len(negatives))
    for r in curve.collect():
        flagged = [y for s, y in rows if s >= r["threshold"]]
        assert (r["tp"], r["fp"]) == (sum(flagged), len(flagged) - sum(flagged))
        assert (r["fn"], r["tn"]) == (len(positives) - r["tp"], len(negatives) - r["fp"])
        assert r["precision"] == r["tp"] / len(flagged) and r["recall"] == r["tp"] / len(positives)
    at = evaluation.figures_at(curve, 0.5).first()
    assert at["flagged"] == sum(s >= 0.5 for s, _ in rows)


def test_one_class_alone_has_no_area(frame):
    for label in (0, 1):
        curve = evaluation.threshold_curve(frame("score double, label int", [(0.1, label), (0.9, label)]), "score")
        assert evaluation.area_under_curve(curve).first()["auc"] is None
    none = evaluation.threshold_curve(frame("score double, label int", []), "score")
    assert none.count() == 0 and evaluation.area_under_curve(none).first()["auc"] is None


def test_running_totals_cross_partitions(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 == 0, F.lit(2)).alias("b")).repartition(9)
    got = running_totals(rows, [("id", "desc")], {"a": "sum_a", "b": "sum_b"}).collect()
    for r in got:
        assert r["sum_a"] == sum(i % 7 for i in range(r["id"], 500))
        assert r["sum_b"] == sum(2 for i in range(r["id"], 500) if i % 3 == 0)


def test_compiled_trees_give_the_models_probability(spark):
    rng = random.Random(2)
    inputs = ["x", "a b", "z"]
    rows = [(float(rng.randrange(6)), rng.random(), rng.gauss(0, 1)) for _ in range(600)]
    data = spark.createDataFrame([(*r, float(r[0] > 2) if rng.random() < 0.9 else 0.0) for r in rows], "x double, `a b` double, z double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"),
                             GBTClassifier(maxIter=6, maxDepth=4, seed=1)]).fit(data)
    scored = model.transform(data).select(
        (F.abs(vector_to_array("probability")[1] - trees.probability_column(model.stages[-1], inputs)) < 1e-12).alias("same"))
    assert tuples(scored.distinct()) == [(True,)]
    plan = data.select(trees.probability_column(model.stages[-1], inputs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan
