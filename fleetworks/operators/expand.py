"""Turning one row into a series, and intervals into daily counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def expand_months(df: DataFrame, first_month: Column, months: int, out: str) -> DataFrame:
    """Repeat each row for ``months`` consecutive months starting at ``first_month``."""
    series = F.sequence(first_month, F.add_months(first_month, months - 1), F.expr("interval 1 month"))
    return df.withColumn(out, F.explode(series))


def expand_days(df: DataFrame, start: Column, end: Column, out: str) -> DataFrame:
    """Repeat each row for every day from ``start`` to ``end``; a row whose end precedes its start vanishes."""
    series = F.when(end >= start, F.sequence(start, end, F.expr("interval 1 day")))
    return df.withColumn(out, F.explode(series))


def calendar_days(df: DataFrame, start: Column, end: Column, out: str = "date_id") -> DataFrame:
    """One row per day between the bounds found in ``df``, e.g. its first and last date."""
    bounds = df.agg(start.alias("lo"), end.alias("hi"))
    return expand_days(bounds, F.col("lo"), F.col("hi"), out).select(out)


def scalar_array(df: DataFrame, column: str) -> Column:
    """The sorted distinct values of a column as one array, read as a scalar subquery.

    Only for domains bounded by nature (calendar days, branches, components): the array travels inside
    the plan, so a projection can expand it with no join and no shuffle.
    """
    values = df.select(column).distinct()
    return values.select(F.array_sort(F.collect_set(column))).scalar()


def each_of(df: DataFrame, values: Column, out: str) -> DataFrame:
    """Pair each row with each element of a bounded array, in place, without a join."""
    return df.withColumn(out, F.explode(values))


def active_count_by_day(df: DataFrame, start: str, end: str, by: list[str], out: str = "active") -> DataFrame:
    """How many intervals ``[start, end]`` are active on each day, per group.

    Counts starts and ends per day first, so a long interval costs two rows whatever its length, and
    the running total only sees one row per group and day.
    """
    valid = df.filter(F.col(end) >= F.col(start))
    steps = (
        valid.select(*by, F.explode(F.array(
            F.struct(F.col(start).alias("day"), F.lit(1).alias("step")),
            F.struct(F.date_add(F.col(end), 1).alias("day"), F.lit(-1).alias("step")),
        )).alias("s"))
        .groupBy(*by, F.col("s.day").alias("day"))
        .agg(F.sum("s.step").alias("step"))
    )
    order = Window.partitionBy(*by).orderBy("day")
    running = (
        steps.withColumn(out, F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("until", F.date_sub(F.lead("day").over(order), 1))
        .filter(F.col(out) > 0)
    )
    return expand_days(running, F.col("day"), F.col("until"), "date_id").select(*by, "date_id", out)
