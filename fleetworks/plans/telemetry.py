"""From single machine events to one row per machine and day, and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetworks import constants as C
from fleetworks.functions import iso_weekday, month_name
from fleetworks.operators import active_count_by_day, calendar_days
from fleetworks.session import settle


def telemetry_daily_rollup(events: DataFrame, utilization: Column) -> DataFrame:
    """Faults by severity and sensor readings per machine and day, with running engine hours.

    ``events`` has equipment_id, event_date, severity and reading; ``utilization`` is the aggregate that gives a day's
    hours from them. The running sum only sees one row per machine and day.
    """
    def faults(level: str) -> Column:
        return F.count_if(F.col("severity") == level).cast("int").alias(f"fault_count_{level.lower()}")

    daily = events.groupBy("equipment_id", F.col("event_date").alias("date_id")).agg(
        utilization.cast("decimal(5,1)").alias("utilization_hours"),
        faults("Info"), faults("Warning"), faults("Critical"),
        (F.sum(F.col("reading").cast("decimal(12,3)")) / F.nullif(F.count("reading"), F.lit(0)).cast("decimal(14,0)"))
        .cast("decimal(20,6)").alias("_mean"),
        F.max(F.col("reading").cast("decimal(12,3)")).cast("decimal(12,3)").alias("max_sensor_reading"),
    )
    so_far = Window.partitionBy("equipment_id").orderBy("date_id").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "equipment_id", "date_id",
        F.sum("utilization_hours").over(so_far).cast("decimal(12,1)").alias("engine_hours"), "utilization_hours",
        "fault_count_info", "fault_count_warning", "fault_count_critical",
        F.round("_mean", 3).cast("decimal(12,3)").alias("avg_sensor_reading"), "max_sensor_reading")


def carry_engine_hours(telemetry: DataFrame) -> DataFrame:
    """Fill missing engine hours with the machine's last known value."""
    so_far = Window.partitionBy("equipment_id").orderBy("date_id").rowsBetween(Window.unboundedPreceding, 0)
    return telemetry.withColumn("engine_hours", F.last("engine_hours", ignorenulls=True).over(so_far))


def calendar(days: DataFrame, padded_names: bool = False) -> DataFrame:
    """Calendar attributes of each date in ``days.date_id``."""
    d = F.col("date_id")
    return days.select(
        "date_id", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        month_name(d, padded_names).alias("month_name"), F.dayofmonth(d).alias("day"),
        iso_weekday(d).alias("day_of_week"), (iso_weekday(d) >= 6).alias("is_weekend"))


def calendar_between(df: DataFrame, start: Column, end: Column, padded_names: bool = False) -> DataFrame:
    """A full calendar between two dates found in a frame."""
    return calendar(calendar_days(df, start, end), padded_names)


def calendar_range(spark: SparkSession, first: str = C.CALENDAR_FIRST, last: str = C.CALENDAR_LAST,
                   padded_names: bool = False) -> DataFrame:
    """The warehouse's own calendar between two fixed dates."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi"))
    return calendar_between(bounds, F.min("lo"), F.max("hi"), padded_names)


def active_windows_daily(intervals: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """Number of intervals active per day and group."""
    return active_count_by_day(intervals, start, end, by, "active_count")


def in_stretches(points: DataFrame, intervals: DataFrame, day: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Points, and intervals that reach one, with the number ``_stretch`` of each stretch of days they touch.

    Only the part of an interval between the first and the last point counts. A stretch is as long as these parts are on
    average, so however long they are, there are at most three rows an interval on average. The intervals are written
    once, since their lengths are read before they are placed.
    """
    first, last = (points.agg(bound(day)).scalar() for bound in (F.min, F.max))
    since, until = F.greatest(F.col(start), first), F.least(F.col(end), last)
    reaching = settle(intervals.filter(F.col(start).isNotNull() & (since <= until)), "intervals")
    days = F.coalesce(reaching.agg(F.ceil(F.avg(F.datediff(until, since) + 1))).scalar(), F.lit(1))

    def stretch(at: Column) -> Column:
        return F.floor(F.unix_date(at) / days).cast("int")

    placed = reaching.withColumn("_stretch", F.explode(F.sequence(stretch(since), stretch(until))))
    return points.withColumn("_stretch", stretch(F.col(day))), placed


def stab(points: DataFrame, intervals: DataFrame, keys: list[str], day: str, start: str, end: str) -> DataFrame:
    """Each point with every interval of its key that contains its day. An interval without end is open.

    Both meet in stretches of days, so the join is a plain equality one.
    """
    placed_points, placed = in_stretches(points, intervals, day, start, end)
    met = placed_points.join(placed, [*keys, "_stretch"])
    return met.filter((F.col(day) >= F.col(start)) & (F.col(end).isNull() | (F.col(day) <= F.col(end)))).drop("_stretch")
