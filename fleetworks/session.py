"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_handed_out: list[str] = []


def build_session(app: str = "fleetworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on: UTC dates and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # streaming state on local disk instead of the executor heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir``, such as a test, gets a temporary folder; on a cluster
    no other machine could read one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="fleetworks-")
        base = _local_scratch[app]
    path = f"{base.rstrip('/')}/fleetworks/{label}-{uuid.uuid4().hex[:12]}"
    _handed_out.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _handed_out:
        _handed_out.remove(path)


@contextmanager
def scratch_cleared(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders handed out inside, at its end. Frames that read them must not be used after that."""
    before = len(_handed_out)
    try:
        yield
    finally:
        while len(_handed_out) > before:
            discard(spark, _handed_out[-1])


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to shared scratch and read it back.

    Use for a frame read several times below, or one whose row placement must not change when a
    lost executor makes Spark recompute it. The copy outlives any executor.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
