"""Event-time daily fault counts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetworks.session import discard
from fleetworks.streaming.landing import KeyedUpsert, batch_folder, drain, path_exists

COUNTS = ["fault_count_info", "fault_count_warning", "fault_count_critical", "event_count", "max_sensor_reading"]
DAILY = ("equipment_id BIGINT, fault_count_info INT, fault_count_warning INT, fault_count_critical INT, "
         "event_count BIGINT, max_sensor_reading DOUBLE, date_id DATE")


def daily_fault_rollup(events: DataFrame, late_by: str | None = None) -> DataFrame:
    """Fault counts per machine, UTC day and severity, for update mode.

    ``events`` has a timestamp ``ts``. Each batch emits the groups it touched with their full counts so far,
    so a keyed upsert of the output is always current. Append mode would hold back the open days and drop
    files that arrive out of order. Without ``late_by`` every day can always be corrected, and the state has as many
    rows as the result. With it, days older than that are closed and rows that come later still are lost: give it only
    where the landed log corrects them in batch.
    """
    day = F.window("ts", "1 day")
    open_days = events.withWatermark("ts", late_by) if late_by else events
    return (
        open_days.groupBy(day.alias("day"), "equipment_id").agg(*_counted())
        .select("equipment_id", _utc_day(F.col("day.start")).alias("date_id"), *COUNTS)
    )


def _utc_day(ts):
    """The UTC date of a timestamp, whatever zone the session shows times in."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / 86400000000).cast("int"))


def _counted() -> list:
    return [*[F.count_if(F.col("severity") == level).cast("int").alias(f"fault_count_{level.lower()}")
              for level in ("Info", "Warning", "Critical")],
            F.count("*").alias("event_count"), F.max("reading").alias("max_sensor_reading")]


class EventLog:
    """Every event as it came, by day, in a folder of its checkpoint and batch, so that a replayed batch replaces itself.

    The days of a batch are noted beside it until they have been checked.
    """

    def __init__(self, path: str):
        self.path, self.touched = f"{path}/events", f"{path}/events_touched"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch, batch_id)
        dated = batch.withColumn("date_id", _utc_day(F.col("ts")))
        dated.write.mode("overwrite").partitionBy("date_id").parquet(f"{self.path}/{folder}")
        # the days are read off the folders just written; no row is read twice
        written = batch.sparkSession.read.parquet(f"{self.path}/{folder}").select("date_id").distinct()
        written.write.mode("overwrite").parquet(f"{self.touched}/{folder}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("equipment_id BIGINT, ts TIMESTAMP, severity STRING, reading DOUBLE, run STRING, batch_id BIGINT, "
                                 "date_id DATE").option("basePath", self.path).parquet(self.path)


class LateRollup:
    """Daily fault counts that stay right however late a row comes, with a bounded state.

    One query keeps every event in a log by day, the other counts the open days and forgets those more than ``late_by``
    behind the newest event, so its state has at most the machines of the open days. Rows that come for a forgotten day
    are in the log alone. ``correct`` finds their days, by comparing the number of events in log and table on the days
    that were touched, and counts these days anew from the log. Events without a time are kept in the log and counted
    nowhere. Both queries can be run again from their checkpoints, and ``correct`` can be repeated.
    """

    def __init__(self, path: str, late_by: str = "2 days"):
        self.late_by, self.log = late_by, EventLog(path)
        self.table = KeyedUpsert(path, "daily_faults", DAILY, ["equipment_id", "date_id"], COUNTS)

    def run(self, events: DataFrame, checkpoint: str) -> list:
        """Log and count everything available now, then correct. Returns the counting query's progress."""
        drain(events, self.log, f"{checkpoint}/log")
        query = (
            daily_fault_rollup(events, self.late_by).writeStream.outputMode("update").foreachBatch(self.table)
            .option("checkpointLocation", f"{checkpoint}/rollup").trigger(availableNow=True).start())
        query.awaitTermination()
        self.correct(events.sparkSession)
        return query.recentProgress

    def correct(self, spark: SparkSession) -> None:
        if not path_exists(spark, self.log.touched):
            return
        touched = spark.read.schema("date_id DATE").parquet(self.log.touched).filter("date_id is not null").distinct()
        # the days prune both tables' partitions when the joins run; only the day is read of the log
        logged = self.log.read(spark).join(touched, "date_id", "left_semi").groupBy("date_id").agg(F.count("*").alias("logged"))
        counted = self.table.read(spark).join(touched, "date_id", "left_semi").groupBy("date_id").agg(
            F.sum("event_count").alias("counted"))
        wrong = logged.join(counted, "date_id", "left").filter(~F.col("logged").eqNullSafe(F.col("counted"))).select("date_id")
        anew = self.log.read(spark).join(wrong, "date_id", "left_semi").groupBy("equipment_id", "date_id").agg(*_counted())
        self.table.replace_days(anew.select("equipment_id", *COUNTS, "date_id"))
        discard(spark, self.log.touched)
