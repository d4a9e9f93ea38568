"""Global order without a single-partition window.

Rows are range-partitioned and sorted, written once so that their placement is settled, and numbered
inside their partition. One small row per partition then carries what came before it. Nothing but that
summary, which has as many rows as there are partitions, ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks.session import settle

_INDEX_BITS = 33


def _order(by: Sequence[str | tuple[str, str]]) -> list[Column]:
    columns = []
    for item in by:
        name, direction = item if isinstance(item, tuple) else (item, "asc")
        columns.append(F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_first())
    return columns


def _placed(df: DataFrame, by, label: str) -> DataFrame:
    """Sorted rows with their partition number and their place inside it, written once."""
    order = _order(by)
    place = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place)
    placed = settle(placed, label)
    return (
        placed.withColumn("_part", F.shiftright("_at", _INDEX_BITS))
        .withColumn("_idx", F.col("_at").bitwiseAND((1 << _INDEX_BITS) - 1)).drop("_at")
    )


def _before(column: str) -> Column:
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def number_rows(df: DataFrame, order_by: Sequence[str | tuple[str, str]], out: str, start: int | Column = 1) -> DataFrame:
    """Dense row numbers over the whole frame in the given order. The order must be total to be repeatable."""
    placed = _placed(df, order_by, "numbered")
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", _before("_n").alias("_rows_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    number = F.col("_rows_before") + F.col("_idx") + first
    # offsets has one row per partition, so it is always small enough to broadcast
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, number.cast("bigint")).drop("_part", "_idx", "_rows_before")
    )


def running_totals(df: DataFrame, order_by: Sequence[str | tuple[str, str]], totals: dict[str, str]) -> DataFrame:
    """Add the running total of each column of ``totals`` under its new name, over the whole frame in the given order.

    Missing values count 0. The order must be total to be repeatable.
    """
    placed = _placed(df, order_by, "totals")
    inside = Window.partitionBy("_part").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    parts = placed.groupBy("_part").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"_sum_{i}") for i, c in enumerate(totals)])
    before = parts.select("_part", *[_before(f"_sum_{i}").alias(f"_before_{i}") for i in range(len(totals))])
    # one row per partition, so it is always small enough to broadcast
    return placed.join(F.broadcast(before), "_part").select(*df.columns, *[
        (F.col(f"_before_{i}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out)
        for i, (c, out) in enumerate(totals.items())])


def rank_and_accumulate(df: DataFrame, value: str, tiebreak: str, rank: str, running: str) -> DataFrame:
    """Competition rank by descending ``value`` and the running total in that order.

    Equal values share a rank, and the next rank skips them; the running total steps through them by
    ``tiebreak``. A value shared by many rows may span partitions: its rank is then taken from the first
    partition that reaches it.
    """
    placed = _placed(df, [(value, "desc"), tiebreak], "ranked")
    descending = F.col(value).desc_nulls_last()
    stepwise = Window.partitionBy("_part").orderBy(descending, "_idx").rowsBetween(Window.unboundedPreceding, 0)
    local = (
        placed.withColumn("_sum", F.sum(value).over(stepwise))
        .withColumn("_rank", F.rank().over(Window.partitionBy("_part").orderBy(descending)))
    )
    parts = local.groupBy("_part").agg(
        F.count("*").alias("_n"), F.sum(value).alias("_total"), F.max(value).alias("_high"),
        F.min(value).alias("_low"), F.max("_rank").alias("_low_rank"),
    ).select("_part", "_high", "_low", "_low_rank", _before("_n").alias("_rows_before"),
             _before("_total").alias("_sum_before"))
    reached = parts.groupBy(F.col("_low").alias("_high")).agg(
        F.min_by(F.col("_rows_before") + F.col("_low_rank"), "_part").alias("_tie_rank"),
        F.min("_part").alias("_tie_part"),
    )
    carried = parts.join(reached, "_high", "left").select(
        "_part", "_rows_before", "_sum_before", "_high",
        F.when(F.col("_tie_part") < F.col("_part"), F.col("_tie_rank"))
        .otherwise(F.col("_rows_before") + 1).alias("_high_rank"),
    )
    # both frames above have one row per partition
    ranked = F.when(F.col(value) == F.col("_high"), F.col("_high_rank")).otherwise(
        F.col("_rows_before") + F.col("_rank"))
    return (
        local.join(F.broadcast(carried), "_part")
        .withColumn(rank, ranked.cast("bigint"))
        .withColumn(running, F.col("_sum_before") + F.col("_sum"))
        .select(*df.columns, rank, running)
    )
