from __future__ import annotations

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from fleetworks import reports
from fleetworks.sources import append_missing, as_messages, write_daily_csv
from fleetworks.sources.testbed import Testbed
from fleetworks.streaming import FaultLanding, KeyedUpsert, TelemetryLanding, daily_fault_rollup, drain, file_source, land_streams
from fleetworks.streaming.landing import merge_rows
from tests.conftest import day, tuples

MESSAGE = "key string, value string"


def message(machine, date, hours=1.0, **extra):
    return (str(machine), json.dumps({"equipment_id": machine, "date_id": date, "utilization_hours": hours, **extra}))


def send(frame, path, *files):
    for rows in files:
        frame(MESSAGE, list(rows)).coalesce(1).write.mode("append").parquet(path)


def test_telemetry_upsert_over_batches_and_restarts(spark, frame, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    sink = TelemetryLanding(target)

    def run():
        drain(sink.decode(file_source(spark, source, 1)), sink, offsets)
        return tuples(sink.read(spark), "equipment_id", "date_id", "utilization_hours", "fault_count_info")

    send(frame, source, [message(1, "2024-01-01", 1.0), message(1, "2024-01-01", 2.0, fault_count_info=3),
                         message(2, "2024-01-02"), ("x", "{bad"), ("y", '{"date_id": "2024-01-01"}')])
    first = run()
    assert first == [(1, day("2024-01-01"), 2.0, 3), (2, day("2024-01-02"), 1.0, None)]
    assert run() == first  # nothing new
    send(frame, source, [message(2, "2024-01-02", 9.0), message(3, "2024-01-01", 5.0)])
    assert run() == [(1, day("2024-01-01"), 2.0, 3), (2, day("2024-01-02"), 9.0, None), (3, day("2024-01-01"), 5.0, None)]
    lost = spark.read.parquet(sink.quarantine)
    assert tuples(lost, "raw") == [('{"date_id": "2024-01-01"}',), ("{bad",)]


def test_replay_repeats_the_swap_from_staging(spark, frame, tmp_path):
    sink = TelemetryLanding(str(tmp_path / "out"))
    batch = sink.decode(frame(MESSAGE, [message(1, "2024-01-01", 4.0), message(1, "2024-01-02", 5.0)]))
    sink(batch, 0)
    once = tuples(sink.read(spark))
    # a crash during the swap may have lost a partition; the replayed batch restores it
    empty = sink.read(spark).filter("false")
    empty.write.mode("overwrite").parquet(str(tmp_path / "out" / "telemetry_daily" / "date_id=2024-01-02"))
    sink(batch, 0)
    assert tuples(sink.read(spark)) == once


def test_a_new_checkpoint_loses_nothing(spark, frame, tmp_path):
    target = str(tmp_path / "out")
    for n, rows in enumerate([[message(1, "2024-01-01", 5.0)], [message(1, "2024-01-01", 6.0), message(2, "2024-01-01", 7.0)]]):
        sink, source = TelemetryLanding(target), str(tmp_path / f"in{n}")
        send(frame, source, rows)
        drain(sink.decode(file_source(spark, source)), sink, str(tmp_path / f"offsets{n}"))
    assert tuples(sink.read(spark), "equipment_id", "utilization_hours") == [(1, 6.0), (2, 7.0)]
    faults = FaultLanding(target)
    for n in range(2):
        source = str(tmp_path / f"faults{n}")
        frame("equipment_id long, event_date string, fault_code string, severity string", [(n, "2024-01-01", "A", "Info")]).transform(
            lambda df: as_messages(df, "equipment_id")).write.parquet(source)
        drain(faults.decode(file_source(spark, source)), faults, str(tmp_path / f"fault-offsets{n}"))
    assert tuples(faults.read(spark), "equipment_id") == [(0,), (1,)]


def test_the_later_file_of_a_batch_wins(spark, frame, tmp_path):
    source, sink = str(tmp_path / "in"), TelemetryLanding(str(tmp_path / "out"))
    for hours in (1.0, 3.0, 2.0):
        send(frame, source, [message(1, "2024-01-01", hours)])
        time.sleep(1.1)
    drain(sink.decode(file_source(spark, source)), sink, str(tmp_path / "offsets"))
    assert tuples(sink.read(spark), "utilization_hours") == [(2.0,)]


def test_an_unreadable_number_never_replaces_a_good_one(spark, frame, tmp_path):
    source, sink = str(tmp_path / "in"), TelemetryLanding(str(tmp_path / "out"))
    send(frame, source, [message(1, "2024-01-01", 4.0)], [message(1, "2024-01-01", "many"), message(2, "2024-01-01", 1e9)])
    for _ in range(2):
        drain(sink.decode(file_source(spark, source, 1)), sink, str(tmp_path / "offsets"))
    assert tuples(sink.read(spark), "equipment_id", "utilization_hours") == [(1, 4.0)]
    assert spark.read.parquet(sink.quarantine).count() == 2


def test_repeated_keys_need_an_order(spark, frame, tmp_path):
    sink = TelemetryLanding(str(tmp_path / "out"))
    with pytest.raises(ValueError):
        sink(sink.decode(frame(MESSAGE, [message(1, "2024-01-01", 4.0), message(1, "2024-01-01", 5.0)])), 0)


def test_untouched_columns_and_days_keep_their_values(spark, frame):
    schema = "equipment_id long, date_id date, engine_hours double, utilization_hours double"
    existing = frame(schema, [(1, day("2024-01-01"), 50.0, 1.0), (2, day("2024-01-01"), 60.0, 1.0)])
    batch = frame("equipment_id long, date_id date, utilization_hours double", [
        (1, day("2024-01-01"), None), (3, day("2024-01-01"), 7.0)])
    assert tuples(merge_rows(existing, batch, ["equipment_id", "date_id"], ["utilization_hours"])) == [
        (1, day("2024-01-01"), 50.0, None), (2, day("2024-01-01"), 60.0, 1.0), (3, day("2024-01-01"), None, 7.0)]


def test_fault_log_is_replay_safe(spark, frame, tmp_path):
    sink = FaultLanding(str(tmp_path))
    good = json.dumps({"equipment_id": 1, "event_date": "2024-01-01", "fault_code": "A", "severity": "Info"})
    batch = sink.decode(frame(MESSAGE, [("1", good), ("1", good), ("1", "nonsense"), ("1", good.replace("2024-01-01", "soon"))]))
    sink(batch, 0)
    sink(batch, 0)
    assert tuples(sink.read(spark).drop("batch_id")) == [(1, day("2024-01-01"), "A", "Info")] * 2
    assert spark.read.parquet(sink.quarantine).count() == 2


def test_both_topics_land(spark, frame, tmp_path):
    faults, daily, out = (str(tmp_path / n) for n in ("faults", "daily", "out"))
    rows = frame("equipment_id long, event_date string, fault_code string, severity string", [(1, "2024-01-01", "A", "Info")])
    as_messages(rows, "equipment_id").write.parquet(faults)
    send(frame, daily, [message(1, "2024-01-01")])
    land_streams(file_source(spark, faults), file_source(spark, daily), out, str(tmp_path / "offsets"))
    assert FaultLanding(out).read(spark).count() == 1 and TelemetryLanding(out).read(spark).count() == 1


def test_rollup_stream_equals_batch_over_shuffled_files(spark, frame, tmp_path):
    source = str(tmp_path / "in")
    start = dt.datetime(2024, 1, 1)
    rows = [(n % 5, start + dt.timedelta(hours=7 * n), ("Info", "Critical")[n % 2], float(n)) for n in range(100)]
    schema = "equipment_id long, ts timestamp, severity string, reading double"
    frame(schema, rows[60:]).coalesce(1).write.parquet(source)  # newest first
    frame(schema, rows[:60]).repartition(3).write.mode("append").parquet(source)
    sink = KeyedUpsert(
        str(tmp_path / "out"), "daily", "equipment_id BIGINT, fault_count_info INT, fault_count_warning INT,"
        " fault_count_critical INT, event_count BIGINT, max_sensor_reading DOUBLE, date_id DATE",
        ["equipment_id", "date_id"],
        ["fault_count_info", "fault_count_warning", "fault_count_critical", "event_count", "max_sensor_reading"])
    stream = daily_fault_rollup(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
    stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "o")).trigger(
        availableNow=True).start().awaitTermination()
    batch = frame(schema, rows).groupBy("equipment_id", F.to_date("ts").alias("date_id")).agg(
        F.count("*").alias("event_count"), F.count_if(F.col("severity") == "Critical").alias("fault_count_critical"))
    columns = ["equipment_id", "date_id", "event_count", "fault_count_critical"]
    assert tuples(sink.read(spark), *columns) == tuples(batch, *columns)


def test_sinks(spark, frame, tmp_path):
    existing = frame("k long, v string", [(1, "old")])
    offered = frame("k long, v string", [(1, "new"), (2, "a"), (2, "a")])
    assert tuples(append_missing(offered, existing, ["k"])) == [(1, "old"), (2, "a")]
    days = frame("date_id date, v long", [(day("2024-01-01"), 1), (day("2024-01-02"), 2)])
    write_daily_csv(days, "date_id", str(tmp_path / "csv"))
    assert (tmp_path / "csv" / "date_id=2024-01-02").is_dir()
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_landed_and_quarantined_rows_are_counted_on_the_way(spark, frame, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    fault = lambda machine: (str(machine), json.dumps({"equipment_id": machine, "event_date": "2024-01-01", "fault_code": "A", "severity": "Info"}))
    send(frame, f"{source}/faults", [fault(1), fault(2), ("x", "{bad")], [fault(3), ("y", '{"equipment_id": 4}'), ("z", "")])
    send(frame, f"{source}/days", [message(1, "2024-01-01"), ("x", "{bad")], [message(1, "2024-01-01", 3.0)])
    faults, days = land_streams(file_source(spark, f"{source}/faults", 1), file_source(spark, f"{source}/days", 1), target, offsets)
    assert tuples(faults.counts.read(spark), "batch_id", "landed", "quarantined") == [(0, 2, 1), (1, 1, 2)]
    assert tuples(days.counts.read(spark), "batch_id", "landed", "quarantined") == [(0, 1, 1), (1, 1, 0)]
    # a replayed batch counts once
    batch = faults.decode(frame(MESSAGE, [fault(9), ("q", "{")]))
    for _ in range(2):
        faults(batch, 7)
    assert tuples(faults.counts.read(spark).filter("batch_id = 7"), "landed", "quarantined") == [(1, 1)]


def test_a_landed_batch_is_decoded_once(spark, frame, tmp_path, monkeypatch):
    sink, asked = FaultLanding(str(tmp_path)), []
    batch = sink.decode(frame(MESSAGE, [("1", json.dumps({"equipment_id": 1, "event_date": "2024-01-01", "fault_code": "A"}))] * 3))
    monkeypatch.setattr(type(batch), "isEmpty", lambda self: asked.append(1))
    held = len(spark._jsc.getPersistentRDDs())
    sink(batch, 0)
    assert not asked and sink.read(spark).count() == 3
    assert len(spark._jsc.getPersistentRDDs()) == held  # what was kept for the batch is released


def test_files_of_a_stream_follow_the_partitions(spark, tmp_path):
    """No task writes a third or half of all messages, and the batches stay two however many files there are."""
    path, partitions = f"{tmp_path}/messages", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 4000, 1, 3).selectExpr("string(id) key", "string(id) value")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        a_batch = reports._as_files(rows, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 12 and a_batch == 6 and max(r["count"] for r in files) < 500


def test_late_rollup_reads_four_batches_however_many_files(spark, tmp_path):
    """The days are written anew with each batch, so many files must not make many batches."""
    rows = spark.range(0, 8000, 1, 12).selectExpr(
        "id event_id", "timestampadd(SECOND, id * 60, timestamp_ntz'2024-01-01') ts", "id % 50 user_id", "'error' event_type",
        "double(id) value", "'' props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    path, a_batch = reports._scattered_events(Testbed(spark, str(tmp_path)), 4)
    files = len(spark.read.parquet(path).inputFiles())
    assert -(-files // a_batch) <= 4 and spark.read.parquet(path).count() == 8000
