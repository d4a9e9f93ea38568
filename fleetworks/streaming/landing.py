"""Landing the two telemetry topics.

Both streams drain what is there and stop, each with its own checkpoint. Both sinks give the same result
when a batch is replayed after a crash: the fault log by overwriting the batch's own folder, the daily table
by an upsert that is prepared in full before any partition is swapped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fleetworks.schemas import FAULT_MESSAGE, TELEMETRY_MESSAGE
from fleetworks.streaming.messages import POSITION, decode

TELEMETRY_COLUMNS = [
    "utilization_hours", "fault_count_info", "fault_count_warning", "fault_count_critical",
    "avg_sensor_reading", "max_sensor_reading",
]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def batch_folder(batch: DataFrame, batch_id: int) -> str:
    """Where a batch's files belong. Batch numbers start again with a new checkpoint, so its query's id is part of it."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    return f"run={run}/batch_id={batch_id}"


def latest_by_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``; an aggregate, so duplicates fold before the shuffle."""
    values = [c for c in batch.columns if c not in keys and c not in order]
    kept = F.max_by(F.struct(*values), F.struct(*order)).alias("kept")
    return batch.groupBy(*keys).agg(kept).select(*keys, "kept.*")


def merge_rows(existing: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Existing rows with the listed columns replaced by the batch's, plus rows the batch adds.

    Columns not listed keep their existing value, and are NULL in a new row.
    """
    incoming = batch.select(*keys, F.struct(*update).alias("_new"))
    joined = existing.join(incoming, list(keys), "full_outer")
    updated = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
        for c in existing.columns if c not in keys
    ]
    return joined.select(*keys, *updated).select(*existing.columns)


class LandingCounts:
    """How many rows each batch landed and quarantined, observed while the batch is decoded for its first use."""

    def __init__(self, path: str, topic: str):
        self.path, self.topic = f"{path}/{topic}_counts", topic

    def observed(self, batch: DataFrame, good: Column) -> tuple[DataFrame, Observation]:
        """The batch, kept for several uses, and what will have been counted after the first."""
        counted = Observation(self.topic)
        return batch.observe(
            counted, F.coalesce(F.count_if(good), F.lit(0)).alias("landed"), F.coalesce(F.count_if(~good), F.lit(0)).alias("quarantined"),
        ).persist(), counted

    def store(self, batch: DataFrame, folder: str, counted: Observation) -> None:
        """One row in the batch's own folder, so that a replay replaces it."""
        found = counted.get
        row = batch.sparkSession.range(1).select(
            F.lit(self.topic).alias("topic"), F.lit(found["landed"]).cast("bigint").alias("landed"),
            F.lit(found["quarantined"]).cast("bigint").alias("quarantined"))
        row.write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("topic STRING, landed BIGINT, quarantined BIGINT, run STRING, batch_id BIGINT").option(
            "basePath", self.path).parquet(self.path)


class FaultLanding:
    """Append-only log of fault events, one folder per checkpoint and batch, so a replayed batch replaces itself.

    Rows without a machine, date or code, or with a field that can't be read, go to the quarantine folder. A batch is
    decoded once, and its landed and quarantined rows are counted in that pass.
    """

    def __init__(self, path: str):
        self.path = f"{path}/faults"
        self.quarantine = f"{path}/faults_quarantine"
        self.counts = LandingCounts(path, "faults")

    def decode(self, messages: DataFrame) -> DataFrame:
        rows = decode(messages, FAULT_MESSAGE)
        return rows.withColumn("event_date", F.try_to_date("event_date"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        good = (F.col("equipment_id").isNotNull() & F.col("event_date").isNotNull() & F.col("fault_code").isNotNull()
                & ~F.col("malformed"))
        folder = batch_folder(batch, batch_id)
        kept, counted = self.counts.observed(batch, good)
        kept.filter(good).drop("raw", "malformed", POSITION).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        kept.filter(~good).select("raw").write.mode("overwrite").parquet(f"{self.quarantine}/{folder}")
        self.counts.store(batch, folder, counted)
        kept.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(
            "equipment_id BIGINT, event_date DATE, fault_code STRING, severity STRING, run STRING, batch_id BIGINT"
        ).option("basePath", self.path).parquet(self.path).drop("run")


class KeyedUpsert:
    """A parquet table partitioned by date, kept at one row per key.

    A batch only touches the dates it carries. The new content of those dates is written to a staging folder of
    its checkpoint and batch first; swapping it in overwrites just these partitions. A replay finds the finished
    staging folder and repeats the swap, so a crash halfway leaves nothing lost and nothing doubled. Of several rows
    of a key in a batch, the one with the greatest position wins; a batch that repeats a key without positions is refused.
    Positions are not stored, so between batches the later batch wins, as a topic's offsets and a folder's file times
    have it; a file that is older than rows already landed still replaces them.
    """

    def __init__(self, path: str, name: str, schema: str, keys: Sequence[str], update: Sequence[str], day: str = "date_id"):
        self.path = f"{path}/{name}"
        self.staging = f"{path}/{name}_staging"
        self.quarantine = f"{path}/{name}_quarantine"
        self.counts = LandingCounts(path, name)
        self.schema, self.keys, self.update, self.day = schema, list(keys), list(update), day

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        folder = batch_folder(batch, batch_id)
        staged = f"{self.staging}/{folder}"
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            kept, counted = self.counts.observed(batch, self._readable(batch))
            self._stage(kept, folder, staged)
            self.counts.store(batch, folder, counted)
            kept.unpersist()
        merged = spark.read.schema(self.schema).parquet(staged)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.path)
        # a later batch only starts once the one before is committed, so its staging can never be needed again
        drop_path(spark, f"{self.staging}/{batch_folder(batch, batch_id - 1)}")

    def _readable(self, batch: DataFrame) -> Column:
        good = reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys])
        return good & ~F.col("malformed") if "malformed" in batch.columns else good

    def _stage(self, batch: DataFrame, folder: str, staged: str) -> None:
        good = self._readable(batch)
        rows = batch.filter(good)
        if "raw" in batch.columns:
            batch.filter(~good).select("raw").write.mode("overwrite").parquet(f"{self.quarantine}/{folder}")
        rows = rows.drop("raw", "malformed")
        if POSITION in rows.columns:
            rows = latest_by_key(rows, self.keys, [POSITION])
        elif not rows.groupBy(*self.keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"a key is repeated and nothing says which row is last: give the source a {POSITION}")
        # the days of the batch prune the table's partitions when the join runs
        affected = self.read(batch.sparkSession).join(rows.select(self.day).distinct(), self.day, "left_semi")
        merged = merge_rows(affected, rows, self.keys, self.update)
        # rebalancing by day keeps files large and still splits a day too big for one task
        merged.hint("rebalance", self.day).write.mode("overwrite").partitionBy(self.day).parquet(staged)

    def replace_days(self, rows: DataFrame) -> None:
        """Replace the days of ``rows``, which are one row per key, by them. Other days stay."""
        staged = f"{self.staging}/replaced"
        rows.hint("rebalance", self.day).write.mode("overwrite").partitionBy(self.day).parquet(staged)
        # an empty write leaves no partition, and so nothing to swap
        done = rows.sparkSession.read.schema(self.schema).parquet(staged)
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.path)
        drop_path(rows.sparkSession, staged)

    def read(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.path)


class TelemetryLanding(KeyedUpsert):
    """Daily telemetry by machine and date. Engine hours are not in the messages and keep their stored value."""

    def __init__(self, path: str):
        super().__init__(
            path, "telemetry_daily",
            "equipment_id BIGINT, engine_hours DECIMAL(6,1), utilization_hours DECIMAL(5,1), fault_count_info INT, "
            "fault_count_warning INT, fault_count_critical INT, avg_sensor_reading DECIMAL(10,3), "
            "max_sensor_reading DECIMAL(10,3), date_id DATE",
            ["equipment_id", "date_id"], TELEMETRY_COLUMNS)

    def decode(self, messages: DataFrame) -> DataFrame:
        rows = decode(messages, TELEMETRY_MESSAGE)
        read = {
            "date_id": F.try_to_date("date_id"),
            "utilization_hours": F.col("utilization_hours").try_cast("decimal(5,1)"),
            "avg_sensor_reading": F.col("avg_sensor_reading").try_cast("decimal(10,3)"),
            "max_sensor_reading": F.col("max_sensor_reading").try_cast("decimal(10,3)"),
        }
        lost = reduce(Column.__or__, [F.col(name).isNotNull() & value.isNull() for name, value in read.items()])
        return rows.withColumns({**read, "malformed": F.col("malformed") | lost})


def drain(rows: DataFrame, sink, checkpoint: str) -> None:
    """Run a stream through everything available now, then stop."""
    query = (
        rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def land_streams(faults: DataFrame | None, telemetry: DataFrame | None, path: str,
                 checkpoint: str) -> tuple[FaultLanding, TelemetryLanding]:
    """Land fault messages, then daily telemetry messages, each with its own checkpoint. Returns both sinks."""
    sinks = FaultLanding(path), TelemetryLanding(path)
    for messages, sink, topic in zip((faults, telemetry), sinks, ("faults", "telemetry_daily")):
        if messages is not None:
            drain(sink.decode(messages), sink, f"{checkpoint}/{topic}")
    return sinks
