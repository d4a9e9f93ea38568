"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Store a result as parquet in its own folder. Never point it at a folder the frame reads from."""
    writer = df.write.mode("overwrite")
    if partition_by:
        # one writer task per partition value would be a hot spot, so only spread by it, do not force it
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _as_text(df: DataFrame) -> DataFrame:
    """Lists as comma-separated text, since CSV has none."""
    return df.select(*[F.array_join(c, ",").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV folder. It keeps one part file per task: reading the folder concatenates them."""
    _as_text(df).write.mode("overwrite").option("header", True).csv(path)


def write_daily_csv(df: DataFrame, day: str, path: str) -> None:
    """One CSV folder per day, ``<path>/<day>=YYYY-MM-DD``.

    Rebalancing by day keeps a day in few files, and splits one too big for a task.
    """
    _as_text(df).hint("rebalance", day).write.mode("overwrite").option("header", True).partitionBy(day).csv(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], parallel: int = 8) -> None:
    """Append over JDBC with a bounded number of connections."""
    df.repartition(parallel).write.jdbc(url, table, mode="append", properties=dict(properties))


def append_missing(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The existing rows plus those new ones whose key is not there yet; existing rows never change.

    Of several new rows of a key the least one is taken, by its other columns in order, so a rerun takes the same one.
    A NULL in a key matches nothing stored.
    """
    values = [c for c in new.columns if c not in keys]
    if values:
        new = new.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_least")).select(*keys, "_least.*").select(*new.columns)
    else:
        new = new.distinct()
    fresh = new.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def as_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) text messages, the value being the row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) messages to a topic. Needs the Kafka connector on the cluster's class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
