from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fleetworks.plans import increments, predictive
from fleetworks.plans.increments import FeatureStore
from tests.conftest import day, tuples

BASE = day("2024-01-01")


def at(n):
    return BASE + dt.timedelta(days=n)


@pytest.fixture
def inputs(frame):
    rng = random.Random(4)
    machines = frame("equipment_id long, model_id long, customer_id long, install_date date, status string", [
        (i, i % 3, i, at(rng.choice([-5, 0, 20, 47])) if i else None, "Decommissioned" if i == 5 else "Active") for i in range(8)])
    parts = frame("component_id int", [(1,), (2,)])
    days = [n for n in range(50) if n % 7 != 3]  # some days have no telemetry at all
    readings = frame("equipment_id long, date_id date, engine_hours decimal(6,1), utilization_hours decimal(5,1)", [
        (i, at(n), D(n), D(1)) for n in days for i in range(8) if rng.random() < 0.6 or i == 1])
    marks = frame("equipment_id long, scheduled_date date", [(rng.randrange(8), at(rng.randrange(-9, 50))) for _ in range(25)])
    faults = frame("equipment_id long, component_id int, date_id date, daily_weighted_score decimal(24,4),"
                   " daily_critical_count long, daily_fault_count long", [
                       (i, c, at(n), D(rng.randrange(1, 90)) / 10, rng.randrange(3), 3)
                       for n in range(-3, 50) for i in range(8) for c in (1, 2) if rng.random() < 0.3])
    return machines, parts, readings, marks, faults


def before(inputs, n):
    machines, parts, readings, marks, faults = inputs
    return (machines, parts, readings.filter(F.col("date_id") < at(n)), marks.filter(F.col("scheduled_date") < at(n)),
            faults.filter(F.col("date_id") < at(n)))


def test_added_days_equal_a_full_rebuild(spark, inputs, tmp_path):
    whole = predictive.labelled_features(*inputs)
    columns = whole.columns
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.build(*before(inputs, 44))
    for n in (44, 46, 47, 48, 49):  # day 45 has no telemetry
        store.add_day(at(n), *inputs)
        wanted = tuples(whole.filter(F.col("date_id") <= at(n)), *columns)
        assert tuples(store.read(), *columns) == wanted
    store.add_day(at(49), *inputs)  # once more
    assert tuples(store.read(), *columns) == wanted
    assert dict(store.read().select(*columns).dtypes) == dict(whole.dtypes)
    with pytest.raises(ValueError, match="rebuild"):
        store.add_day(at(46), *inputs)


def test_a_day_reads_the_partitions_of_its_windows(spark, inputs, tmp_path):
    machines, parts, readings, marks, _ = inputs
    every_day = spark.range(50).select(F.lit(1).cast("long").alias("equipment_id"), F.expr("date'2024-01-01' + int(id)").alias("date_id"))
    faults = every_day.select("equipment_id", F.lit(1).alias("component_id"), "date_id", F.lit(D("1.0000")).cast("decimal(24,4)").alias(
        "daily_weighted_score"), F.lit(1).cast("long").alias("daily_critical_count"), F.lit(1).cast("long").alias("daily_fault_count"))
    store = FeatureStore(spark, str(tmp_path / "store"))
    telemetry = every_day.withColumns({"engine_hours": F.lit(None).cast("decimal(6,1)"), "utilization_hours": F.lit(None).cast("decimal(5,1)")})
    store.build(machines, parts, telemetry, marks, faults)
    tail = store.tail(at(45))
    folders = {re.search(r"date_id=([\d-]+)", r["f"]).group(1) for r in tail.select(F.col("_metadata.file_path").alias("f")).collect()}
    assert folders == {at(n).isoformat() for n in range(16, 46)} and len(folders) == 30
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in plan


def test_partitions_grow_with_the_grid(frame):
    machines = frame("equipment_id long", [(i,) for i in range(6)])
    components = frame("component_id int", [(1,), (2,)])
    telemetry = frame("equipment_id long, date_id date", [(i, at(n)) for i in range(6) for n in range(5)])
    assert predictive.grid_partitions(machines, components, telemetry) == 4  # as many as a shuffle has in the tests
    assert predictive.grid_partitions(machines, components, telemetry, rows_a_task=7) == 9


def test_a_large_day_is_written_by_several_tasks(spark, inputs, tmp_path, monkeypatch):
    monkeypatch.setattr(increments, "ROWS_A_TASK", 4)
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.build(*inputs[:5])
    assert len(list((tmp_path / "store" / "features" / f"date_id={at(48)}").glob("*.parquet"))) > 1
