"""Aggregations the plans share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.functions.dates import month_start


def monthly_sum(df: DataFrame, keys: Sequence[str], day: str, **sums: Column) -> DataFrame:
    """Sums per key and calendar month."""
    return df.groupBy(*keys, month_start(F.col(day)).alias("period_month")).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )


def conditional_pivot(df: DataFrame, keys: Sequence[str], on: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """Sum ``value`` into one column per listed category, 0 where a category is absent, plus the overall sum."""
    zero = F.lit(0)
    cells = [
        F.sum(F.when(F.col(on) == category, F.col(value)).otherwise(zero)).alias(name)
        for category, name in columns.items()
    ]
    return df.groupBy(*keys).agg(*cells, F.sum(value).alias("total"))


def share_of_group(value: str, keys: Sequence[str]) -> Column:
    """Total of ``value`` over the group, for dividing a row by its own group's total."""
    return F.sum(value).over(Window.partitionBy(*keys))


def best_per_group(df: DataFrame, keys: Sequence[str], order: Column, keep: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` in each group.

    An aggregate, not a window: each task keeps one candidate per group before the shuffle.
    ``order`` must be unique within a group for a repeatable answer.
    """
    best = F.min_by(F.struct(*keep), order).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.{c}").alias(c) for c in keep])


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
