"""Gaps between consecutive days of a key, and grouping of days that lie close together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def gap_since_previous(df: DataFrame, by: Sequence[str], day: str, out: str) -> DataFrame:
    """One row per key and distinct day with the days since the key's previous one and the row count ``n``."""
    days = df.groupBy(*by, day).agg(F.count("*").alias("n"))
    previous = F.lag(day).over(Window.partitionBy(*by).orderBy(day))
    return days.withColumn(out, F.datediff(F.col(day), previous))


def cluster_by_gap(df: DataFrame, by: Sequence[str], day: str, max_gap: int, out: str) -> DataFrame:
    """Number the runs of days in which no step exceeds ``max_gap`` days, from 1 within each key."""
    order = Window.partitionBy(*by).orderBy(day)
    days = df.select(*by, day).distinct()
    starts = F.when(F.datediff(F.col(day), F.lag(day).over(order)) <= max_gap, 0).otherwise(1)
    runs = days.withColumn("_start", starts).withColumn(
        out, F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return df.join(runs.drop("_start"), [*by, day])
