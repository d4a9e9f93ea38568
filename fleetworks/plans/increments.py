"""Features kept by day: a new day is computed from the days its windows reach back to, not from the whole grid."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetworks import constants as C
from fleetworks.operators import each_of, scalar_array
from fleetworks.plans.predictive import GRID, ROWS_A_TASK, SCORE, grid_partitions, labelled_features

#: The longest rolling window in days; a day needs as many partitions of fault scores.
WINDOW_DAYS = 30


class FeatureStore:
    """Three tables under one path, each partitioned by ``date_id``.

    ``features`` is the grid with its rolling sums; ``fault_days`` the daily fault scores on telemetry dates; ``marks``
    the last maintenance date known per machine as of that day. A day is written by replacing its own partitions, so
    adding it again changes nothing. Days are added in their order; a machine-day that comes late needs a rebuild from it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.path}/{table}"

    def _write(self, df: DataFrame, table: str, partitions: int, slices: int) -> None:
        # rows of a day stay together, in as many slices as the day's grid needs: a task sorts what it writes, and adaptive
        # execution would size it by bytes that shrink in a shuffle far more than they do in a sort
        slice_of_day = F.pmod(F.xxhash64("equipment_id"), F.lit(slices))
        df.repartition(partitions, "date_id", slice_of_day).write.mode("overwrite").partitionBy("date_id").parquet(self._folder(table))

    def _write_day(self, df: DataFrame, table: str, day: date) -> None:
        df.drop("date_id").write.mode("overwrite").parquet(f"{self._folder(table)}/date_id={day.isoformat()}")

    def read(self, table: str = "features") -> DataFrame:
        df = self.spark.read.parquet(self._folder(table))
        return df.withColumn("date_id", F.col("date_id").cast("date"))

    def days(self) -> list[date]:
        """The days added so far, by the names of their folders."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder("marks"))
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)
        names = [status.getPath().getName() for status in found]
        return sorted(date.fromisoformat(n.removeprefix("date_id=")) for n in names if n.startswith("date_id="))

    def build(self, equipment: DataFrame, components: DataFrame, telemetry: DataFrame, maintenance: DataFrame,
              component_faults: DataFrame) -> None:
        """Everything from the whole history given."""
        newest = telemetry.agg(F.max("date_id")).first()[0]
        partitions = grid_partitions(equipment, components, telemetry)
        slices = -(-equipment.count() * components.count() // ROWS_A_TASK) or 1
        features = labelled_features(equipment, components, telemetry, maintenance, component_faults, partitions=partitions)
        self._write(features, "features", partitions, slices)
        dates = scalar_array(telemetry, "date_id")
        self._write(component_faults.filter(F.array_contains(dates, F.col("date_id"))), "fault_days", partitions, slices)
        marks = maintenance.filter(F.col("scheduled_date") <= newest).groupBy("equipment_id").agg(
            F.max("scheduled_date").alias("last_mark"))
        self._write_day(marks, "marks", newest)

    def tail(self, day: date) -> DataFrame:
        """Fault scores of the days that the windows of ``day`` reach back to. Only their partitions are read."""
        first = day - timedelta(days=WINDOW_DAYS - 1)
        days = self.spark.read.parquet(self._folder("fault_days")).filter(F.col("date_id").between(first, day))
        return days.withColumn("date_id", F.col("date_id").cast("date"))

    def add_day(self, day: date, equipment: DataFrame, components: DataFrame, telemetry: DataFrame, maintenance: DataFrame,
                component_faults: DataFrame) -> DataFrame:
        """Add the telemetry date ``day`` and return its features. Frames may hold more than the day; the rest is filtered away."""
        *earlier, last = [d for d in self.days() if d != day]
        if last > day:
            raise ValueError(f"{day} comes before {last}, which is there already: rebuild from {day} on")
        self._write_day(component_faults.filter(F.col("date_id") == F.lit(day)), "fault_days", day)
        new_marks = maintenance.filter(F.col("scheduled_date").between(last + timedelta(days=1), day)).groupBy("equipment_id").agg(
            F.max("scheduled_date").alias("last_mark"))
        known = self.spark.read.parquet(f"{self._folder('marks')}/date_id={last.isoformat()}")
        self._write_day(known.unionByName(new_marks).groupBy("equipment_id").agg(F.max("last_mark").alias("last_mark")), "marks", day)
        self._write_day(self._features(day, equipment, components, telemetry), "features", day)
        return self.read().filter(F.col("date_id") == F.lit(day))

    def _features(self, day: date, equipment: DataFrame, components: DataFrame, telemetry: DataFrame) -> DataFrame:
        today = F.lit(day)
        machines = equipment.filter(F.col("status").isin("Active", "Idle") & (F.col("install_date") <= today)).select(
            "equipment_id", "model_id", "customer_id", "install_date")
        readings = telemetry.filter(F.col("date_id") == today).groupBy("equipment_id").agg(
            F.max("engine_hours").alias("engine_hours"), F.max("utilization_hours").alias("utilization_hours"),
            F.lit(True).alias("_read"))
        marks = self.spark.read.parquet(f"{self._folder('marks')}/date_id={day.isoformat()}")
        # the last maintenance date is only known on days with a reading or a mark of their own
        known = F.col("_read").isNotNull() | (F.col("last_mark") == today)
        since = F.coalesce(F.when(known, F.datediff(today, "last_mark")), F.lit(C.NEVER_MAINTAINED_DAYS))
        context = machines.join(readings, "equipment_id", "left").join(marks, "equipment_id", "left").select(
            "equipment_id", "model_id", "customer_id", F.datediff(today, "install_date").alias("machine_age_days"),
            "engine_hours", "utilization_hours", since.alias("days_since_last_maintenance"))
        age = F.datediff(today, F.col("date_id"))

        def within(days: int, column: str):
            return F.sum(F.when(age < days, F.col(column)))

        seen = (
            self.tail(day).join(machines.select("equipment_id", "install_date"), "equipment_id")
            .filter(F.col("date_id") >= F.col("install_date")).groupBy(*GRID).agg(
                *[within(1, c).alias(c) for c in ("daily_weighted_score", "daily_critical_count", "daily_fault_count")],
                *[within(n, "daily_weighted_score").alias(f"weighted_score_{n}d") for n in (7, 14, WINDOW_DAYS)],
                *[within(n, "daily_critical_count").alias(f"critical_count_{n}d") for n in (7, 14)]))
        pairs = each_of(context, scalar_array(components, "component_id"), "component_id")
        sums = [c for c in seen.columns if c not in GRID]
        filled = {c: F.coalesce(F.col(c), F.lit(0)).cast(SCORE if "score" in c else "bigint") for c in sums}
        return pairs.join(seen, GRID, "left").select(
            *GRID, "model_id", "customer_id", *[filled[c].alias(c) for c in sums], "machine_age_days", "engine_hours",
            "utilization_hours", "days_since_last_maintenance")
