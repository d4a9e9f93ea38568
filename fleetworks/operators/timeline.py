"""As-of lookups, rolling day windows and look-ahead flags.

Each works on a union of both inputs and one window per key ordered by day number. There is no
inequality join, so no pair of rows is ever formed. Rows and marks are reduced to one per key and day first,
so what one key brings into a window is bounded by the days in its history, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.functions.dates import day_number


def _nearest(rows: DataFrame, marks: DataFrame, by: Sequence[str], day: str, mark_day: str, out: str, pick, frame,
             unique: bool) -> DataFrame:
    keys = [*by, day]
    days = rows if unique else rows.select(*keys).filter(F.col(day).isNotNull()).distinct()
    points = (
        marks.select(*by, F.col(mark_day).alias(day)).filter(F.col(day).isNotNull()).distinct()
        .withColumn("_mark", F.col(day)).withColumn("_row", F.lit(False))
    )
    tagged = days.withColumn("_mark", F.lit(None).cast("date")).withColumn("_row", F.lit(True))
    window = frame(Window.partitionBy(*by).orderBy("_day"))
    found = (
        tagged.unionByName(points, allowMissingColumns=True).withColumn("_day", day_number(F.col(day)))
        .withColumn(out, pick("_mark", ignorenulls=True).over(window))
        .filter("_row").drop("_mark", "_row", "_day")
    )
    return found if unique else rows.join(found, keys, "left").select(*rows.columns, out)


def carry_forward(rows: DataFrame, marks: DataFrame, by: Sequence[str], day: str, mark_day: str, out: str,
                  unique: bool = False) -> DataFrame:
    """Add the latest mark on or before each row's day, NULL if there is none.

    ``unique`` says that the rows are already one per key and day, which saves looking up distinct days first.
    """
    return _nearest(rows, marks, by, day, mark_day, out, F.last,
                    lambda w: w.rangeBetween(Window.unboundedPreceding, Window.currentRow), unique)


def next_at_or_after(rows: DataFrame, marks: DataFrame, by: Sequence[str], day: str, mark_day: str, out: str,
                     unique: bool = False) -> DataFrame:
    """Add the earliest mark on or after each row's day, NULL if there is none."""
    return _nearest(rows, marks, by, day, mark_day, out, F.first,
                    lambda w: w.rangeBetween(Window.currentRow, Window.unboundedFollowing), unique)


def exists_within(rows: DataFrame, marks: DataFrame, by: Sequence[str], day: str, mark_day: str, within: Column,
                  out: str) -> DataFrame:
    """Flag rows that have a mark in ``[day, day + within]``.

    The nearest mark from the row's day onward decides it: if that one is too late, every other is too.
    """
    found = next_at_or_after(rows, marks, by, day, mark_day, "_next")
    inside = F.col("_next") <= F.date_add(F.col(day), within)
    return found.withColumn(out, F.coalesce(inside, F.lit(False))).drop("_next")


def rolling_days(value: str, by: Sequence[str], day_no: str, days: int) -> Column:
    """Sum over the trailing ``days`` days including the row's own; a missing day cannot stretch the frame."""
    return F.sum(value).over(Window.partitionBy(*by).orderBy(day_no).rangeBetween(-(days - 1), 0))


def flag_upcoming(mark: str, by: Sequence[str], day_no: str, days: int) -> Column:
    """1 when a marked row of the same key lies in the next ``days`` days, the row's own day excluded."""
    ahead = F.max(mark).over(Window.partitionBy(*by).orderBy(day_no).rangeBetween(1, days))
    return F.coalesce(ahead, F.lit(0))
