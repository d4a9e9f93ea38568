"""Exact quality figures of a score against 0/1 labels.

Rows fold to one per distinct score first. Those are range-partitioned and counted up by partition sums, so neither a
popular score nor the number of rows ever meets in one task. Equal scores share one threshold and count half in the area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetworks.functions import safe_ratio
from fleetworks.operators import running_totals

EXACT = "decimal(38,0)"


def threshold_curve(rows: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Per distinct score: what a threshold at it flags (tp, fp) and misses (fn, tn), precision and recall.

    Rows without a score or label don't count. Precision is NULL never, recall NULL without a positive row.
    """
    steps = rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    counted = running_totals(steps, [("threshold", "desc")], {"positives": "tp", "negatives": "fp"})
    all_positives, all_negatives = (counted.agg(F.coalesce(F.sum(c), F.lit(0))).scalar() for c in ("positives", "negatives"))
    return counted.withColumns({
        "fn": all_positives - F.col("tp"), "tn": all_negatives - F.col("fp")}).withColumns({
            "precision": F.col("tp") / (F.col("tp") + F.col("fp")), "recall": safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))})


def area_under_curve(curve: DataFrame) -> DataFrame:
    """One row (auc, positives, negatives): the share of pairs in the right order, equal scores counting half.

    Counted in whole numbers up to the last division. NULL without a positive or a negative row.
    """
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("positives", "negatives", "tn")}
    twice = exact["positives"] * (exact["tn"] * 2 + exact["negatives"])
    summed = curve.agg(F.sum(twice.cast(EXACT)).alias("twice"), F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
                       F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    return summed.select(safe_ratio(F.col("twice").cast("double"), pairs).alias("auc"), "positives", "negatives")


def figures_at(curve: DataFrame, threshold: float) -> DataFrame:
    """One row (precision, recall, flagged) of flagging every score of at least ``threshold``."""
    at: Column = F.col("threshold") >= threshold
    flagged = curve.agg(F.coalesce(F.sum(F.when(at, F.col("positives"))), F.lit(0)).alias("tp"),
                        F.coalesce(F.sum(F.when(at, F.col("negatives"))), F.lit(0)).alias("fp"), F.sum("positives").alias("all"))
    return flagged.select(safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                          safe_ratio(F.col("tp"), F.col("all")).alias("recall"), (F.col("tp") + F.col("fp")).alias("flagged"))
