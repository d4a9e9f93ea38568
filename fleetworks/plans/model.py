"""The failure classifier: gradient-boosted trees on the rolling features."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from fleetworks import constants as C
from fleetworks.plans.evaluation import threshold_curve
from fleetworks.plans.predictive import holdout_split, triage_status
from fleetworks.plans.trees import probability_column
from fleetworks.session import settle

#: Values of a feature that a tree can tell apart, as Spark's own trees have it, and how often edges are looked for.
MAX_BINS, EDGE_PASSES = 32, 6
#: Rows of bins in one task of boosting, about.
CELLS_A_TASK = 20_000
BINS = [f"{c}_bin" for c in C.FEATURES]


@dataclass(frozen=True)
class Evaluation:
    auc: float
    precision: float
    recall: float
    confusion: dict[tuple[int, int], int]


def _inputs(features: DataFrame) -> DataFrame:
    """Feature columns as doubles, a missing value counting 0."""
    cast = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in C.FEATURES}
    return features.withColumns(cast)


def bin_edges(rows: DataFrame, columns: list[str], bins: int = MAX_BINS) -> list[list[float]]:
    """Per column up to ``bins - 1`` ascending values at which bins start, from all rows.

    They are quantiles. A value so frequent that several quantiles fall on it is left out when the rest is divided again,
    so a feature that is mostly 0 keeps its bins for what is not.
    """
    edges: list[set[float]] = [set() for _ in columns]
    frequent: list[set[float]] = [set() for _ in columns]
    open_ = set(range(len(columns)))
    for _ in range(EDGE_PASSES):
        if not open_:
            break
        asked = {}
        for i in sorted(open_):
            room = bins - 1 - len(edges[i])
            value = F.col(f"`{columns[i]}`")
            rest = F.when(~value.isin(*frequent[i]), value) if frequent[i] else value
            asked[i] = F.percentile_approx(rest, [k / room for k in range(room)], 10_000).alias(str(i))
        found = rows.agg(*asked.values()).first()
        for i in asked:
            values = [v for v in found[str(i)] or [] if math.isfinite(v)]
            repeated = {v for v, after in zip(values, values[1:]) if v == after}
            edges[i] |= set(values)
            frequent[i] |= repeated
            if not repeated or len(edges[i]) >= bins - 1:
                open_.discard(i)
    return [sorted(e) for e in edges]


def binner(rows: DataFrame) -> Bucketizer:
    """Feature columns to the bins that their values over all rows suggest. NaN is a bin of its own, above the others."""
    splits = [[-math.inf, *(edges or [0.0]), math.inf] for edges in bin_edges(rows, C.FEATURES)]
    return Bucketizer(splitsArray=splits, inputCols=C.FEATURES, outputCols=BINS, handleInvalid="keep")


def _spread(cells: DataFrame) -> DataFrame:
    """Rows placed and ordered by their bins, since boosting passes over them hundreds of times and its splits follow the placement."""
    tasks = min(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells.count() // CELLS_A_TASK))
    return cells.repartition(max(1, tasks), "label", *BINS).sortWithinPartitions("label", *BINS)


def confusion_counts(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per (label, prediction); the column named by ``weight``, if any, says how many a row stands for."""
    n = F.count("*") if weight is None else F.sum(weight).cast("bigint")
    return predictions.groupBy(F.col("label").cast("int").alias("label"),
                               F.col("prediction").cast("int").alias("prediction")).agg(n.alias("n"))


def train_and_evaluate(features: DataFrame, holdout_days: int = C.HOLDOUT_DAYS, purge_days: int = 0,
                       max_iter: int = 50, max_depth: int = 5, seed: int = 42) -> tuple[PipelineModel, Evaluation]:
    """Fit on the days before the holdout and judge on the holdout, never on shuffled rows.

    Trees see no more of a feature than its bin. So rows are binned first, and those with equal bins and label become one
    that weighs as many: boosting then passes over cells instead of the grid, with the same sums. All rows count, in the
    bins' edges too. Edges and cells take a few passes over the rows: pass features that were settled first.
    """
    tagged = holdout_split(_inputs(features), holdout_days, purge_days).select("split", "label", *C.FEATURES)
    bins = binner(tagged.filter(F.col("split") == "train"))
    # bins are ordered, so trees must not take them for categories, which the bucketizer's metadata says they are
    binned = bins.transform(tagged).select("split", "label", *[F.col(c).alias(c, metadata={}) for c in BINS])
    cells = settle(binned.groupBy("split", "label", *BINS).agg(F.count("*").cast("double").alias("weight")), "cells")
    stages = [
        VectorAssembler(inputCols=BINS, outputCol="features"),
        GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter, maxDepth=max_depth,
                      maxBins=MAX_BINS + 1, seed=seed),
    ]
    fitted = Pipeline(stages=stages).fit(_spread(cells.filter(F.col("split") == "train").drop("split")))
    model = PipelineModel(stages=[bins, *fitted.stages])
    judged = fitted.transform(cells.filter(F.col("split") == "test")).select("label", "prediction", "rawPrediction", "weight").persist()
    counts = {(r["label"], r["prediction"]): r["n"] for r in confusion_counts(judged, "weight").collect()}  # at most four rows
    hit = counts.get((1, 1), 0)
    flagged = hit + counts.get((0, 1), 0)
    actual = hit + counts.get((1, 0), 0)
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", weightCol="weight").evaluate(judged)
    judged.unpersist()
    return model, Evaluation(auc, hit / flagged if flagged else 0.0, hit / actual if actual else 0.0, counts)


def judge(model: PipelineModel, features: DataFrame, holdout_days: int = C.HOLDOUT_DAYS) -> DataFrame:
    """The threshold curve of the model on the held-out days, scored by the compiled trees."""
    held_out = holdout_split(_inputs(features), holdout_days).filter(F.col("split") == "test")
    return threshold_curve(held_out.select("label", compiled_probability(model).alias("probability")), "probability")


def compiled_probability(model: PipelineModel) -> Column:
    """The model's probability of a failure as an expression over the feature columns as doubles."""
    return probability_column(model.stages[-1], C.FEATURES, model.stages[0].getSplitsArray())


def score_day(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Failure probability of every row given, by the compiled trees: code generated by Spark, without vectors.

    Fifty trees outgrow the one method of a fused stage. Spark logs that and generates many small methods instead.
    """
    scored = _inputs(features).withColumn("failure_probability", compiled_probability(model))
    return scored.select(
        "equipment_id", "component_id", F.col("date_id").alias("scoring_date"), "failure_probability",
        triage_status(F.col("failure_probability")).alias("signal_status"), "weighted_score_7d", "critical_count_7d")


def score_latest(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Failure probability of every machine and component on the newest day."""
    newest = features.agg(F.max("date_id")).scalar()
    scored = model.transform(_inputs(features.filter(F.col("date_id") == newest)))
    return scored.withColumn("failure_probability", vector_to_array("probability")[1]).select(
        "equipment_id", "component_id", F.col("date_id").alias("scoring_date"), "failure_probability",
        triage_status(F.col("failure_probability")).alias("signal_status"),
        "weighted_score_7d", "critical_count_7d")
