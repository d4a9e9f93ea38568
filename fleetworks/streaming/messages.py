"""Message streams in and decoded rows out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MESSAGE = "key STRING, value STRING"
#: Where a message stands among the others of its source; a later one compares greater.
POSITION = "position"


def kafka_source(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic from its earliest offset. Needs the Kafka connector on the cluster's class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest")
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    position = F.struct(F.lit(None).cast("timestamp").alias("time"), F.format_string("%s-%010d", "topic", "partition").alias("source"),
                        F.col("offset").alias("at"))
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), position.alias(POSITION))


def file_source(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages arriving as parquet files of (key, value)."""
    position = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("source"),
                        F.col("_metadata.row_index").alias("at"))
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(path).select(
        "key", "value", position.alias(POSITION))


def decode(messages: DataFrame, payload: str) -> DataFrame:
    """Message values as columns, with the raw text and whether a field was there but could not be read.

    The position among the source's messages is passed on where there is one.
    """
    text = F.col("value").cast("string")
    placed = [POSITION] if POSITION in messages.columns else []
    parsed = messages.select(
        F.from_json(text, payload).alias("data"), F.from_json(text, "MAP<STRING, STRING>").alias("given"), text.alias("raw"), *placed)
    unread = [F.col("given")[f.name].isNotNull() & F.col(f"data.{f.name}").isNull()
              for f in T.StructType.fromDDL(payload)]
    malformed = F.coalesce(reduce(Column.__or__, unread), F.lit(False))
    return parsed.select("data.*", "raw", malformed.alias("malformed"), *placed)
