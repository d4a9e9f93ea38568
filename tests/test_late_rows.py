from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetworks.streaming import LateRollup

SCHEMA = "equipment_id long, ts timestamp, severity string, reading double"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _rows(seed, n, days):
    rng = random.Random(seed)
    return [(rng.randrange(5), START + dt.timedelta(seconds=rng.randrange(days * 86400)), rng.choice(["Info", "Warning", "Critical"]),
             float(rng.randrange(100))) for _ in range(n)]


def _expected(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).filter("ts is not null")
    return sorted(tuple(r) for r in df.groupBy("equipment_id", F.to_date("ts").alias("d")).agg(
        F.count("*"), F.count_if(F.col("severity") == "Critical"), F.max("reading")).collect())


def _found(rollup, spark):
    return sorted(tuple(r) for r in rollup.table.read(spark).select(
        "equipment_id", "date_id", "event_count", "fault_count_critical", "max_sensor_reading").collect())


def test_late_rows_are_counted_and_the_state_stays_small(spark, tmp_path):
    source, rollup, seen = str(tmp_path / "in"), LateRollup(str(tmp_path / "out"), "1 day"), []
    events = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    for step, (n, days) in enumerate([(200, 40), (150, 20), (100, 40), (50, 3)]):
        rows = _rows(step, n, days)
        seen += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        progress = rollup.run(events(), str(tmp_path / "offsets"))
        assert _found(rollup, spark) == _expected(spark, seen)
        dropped = sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators)
        if step:
            assert dropped > 0
        # of 200 machine-days only the open ones are held, and those that the next batch will drop
        assert progress[-1].stateOperators[0].numRowsTotal <= 5 * 5


def test_correcting_again_changes_nothing(spark, tmp_path):
    source, rollup, rows = str(tmp_path / "in"), LateRollup(str(tmp_path / "out")), _rows(9, 60, 10) + [(1, None, "Info", 1.0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(source)
    rollup.run(spark.readStream.schema(SCHEMA).parquet(source), str(tmp_path / "offsets"))
    wanted = _expected(spark, rows)
    assert _found(rollup, spark) == wanted
    rollup.correct(spark)
    assert _found(rollup, spark) == wanted
