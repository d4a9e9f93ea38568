from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from fleetworks.plans import predictive, telemetry
from tests.conftest import day, tuples

BASE = day("2024-01-01")


def at(n):
    return BASE + dt.timedelta(days=n)


def equipment(frame, *rows):
    return frame("equipment_id long, model_id long, customer_id long, install_date date, status string", list(rows))


def readings(frame, *rows):
    return frame("equipment_id long, date_id date, engine_hours decimal(6,1), utilization_hours decimal(5,1)", list(rows))


def components(frame, *ids):
    return frame("component_id int", [(i,) for i in ids])


MARKS = "equipment_id long, scheduled_date date"
DAILY = ("equipment_id long, component_id int, date_id date, daily_weighted_score decimal(24,4),"
         " daily_critical_count long, daily_fault_count long")


def test_faults_fan_out_by_weight_and_unmapped_codes_drop(frame):
    faults = frame("equipment_id long, event_date date, fault_code string, severity string", [
        (1, at(0), "A", "Critical"), (1, at(0), "A", "Info"), (1, at(0), "X", "Critical")])
    bridge = frame("fault_code string, component_id int, correlation_weight decimal(4,3)", [
        ("A", 1, D("0.900")), ("A", 2, D("0.500"))])
    got = predictive.fault_component_daily(faults, bridge)
    assert tuples(got.withColumn("daily_weighted_score", F.col("daily_weighted_score").cast("double"))) == [
        (1, 1, at(0), 3.6, 1, 2), (1, 2, at(0), 2.0, 1, 2)]


def test_spine_covers_working_machines_from_installation(frame):
    machines = equipment(frame, (1, 7, 1, at(1), "Active"), (2, 7, 1, at(0), "Decommissioned"), (3, 7, 1, None, "Idle"))
    telemetry_days = readings(frame, (2, at(0), None, None), (2, at(1), None, None), (2, at(4), None, None))
    spine = predictive.dense_spine(machines, components(frame, 1, 2), telemetry_days)
    assert tuples(spine, "equipment_id", "component_id", "date_id") == [
        (1, 1, at(1)), (1, 1, at(4)), (1, 2, at(1)), (1, 2, at(4))]


def test_maintenance_carries_from_before_telemetry(frame):
    got = predictive.maintenance_asof(
        readings(frame, (1, at(0), None, None), (1, at(5), None, None), (2, at(5), None, None)),
        frame(MARKS, [(1, at(-3)), (1, at(3)), (1, at(3))]))
    assert tuples(got) == tuples(frame("e long, d date, m date", [
        (1, at(-3), at(-3)), (1, at(0), at(-3)), (1, at(3), at(3)), (1, at(5), at(3)), (2, at(5), None)]))


def features(frame, faults, failures=None, marks=(), telemetry_rows=None):
    machines = equipment(frame, (1, 7, 1, at(0), "Active"))
    days = telemetry_rows or [(9, at(n), None, None) for n in (0, 1, 8, 9, 30)]
    failed = frame("equipment_id long, component_id int, failure_date date", failures) if failures is not None else None
    return predictive.labelled_features(
        machines, components(frame, 1), readings(frame, *days), frame(MARKS, list(marks)), frame(DAILY, faults), failed)


def test_windows_count_days_not_rows(frame):
    fault = [(1, 1, at(n), D(score), 1, 1) for n, score in ((0, 1), (1, 2), (8, 4))]
    got = {r["date_id"]: r for r in features(frame, fault).collect()}
    assert [float(got[at(n)]["weighted_score_7d"]) for n in (0, 1, 8, 9, 30)] == [1, 3, 4, 4, 0]
    assert [float(got[at(n)]["weighted_score_14d"]) for n in (8, 9, 30)] == [7, 7, 0]
    assert float(got[at(30)]["weighted_score_30d"]) == 6  # day 1 is 29 days back, day 0 is 30
    assert got[at(9)]["critical_count_14d"] == 3 and got[at(30)]["machine_age_days"] == 30


def test_faults_outside_the_grid_do_not_count(frame):
    fault = [(1, 1, at(-2), D(5), 1, 1), (1, 1, at(3), D(5), 1, 1), (2, 1, at(0), D(5), 1, 1), (1, 1, at(1), D(2), 0, 1)]
    got = {r["date_id"]: float(r["weighted_score_7d"]) for r in features(frame, fault).collect()}
    assert got == {at(0): 0, at(1): 2, at(8): 0, at(9): 0, at(30): 0}


def test_days_since_maintenance_needs_a_reading_that_day(frame):
    days = [(1, at(0), D("5.0"), D("1.0")), (1, at(2), D("7.0"), D("2.0")), (9, at(1), None, None)]
    got = {r["date_id"]: r for r in features(frame, [], marks=[(1, at(-4))], telemetry_rows=days).collect()}
    assert [got[at(n)]["days_since_last_maintenance"] for n in (0, 1, 2)] == [4, 9999, 6]
    assert [got[at(n)]["engine_hours"] for n in (0, 1, 2)] == [D("5.0"), None, D("7.0")]


def test_label_edges(frame):
    days = [(9, at(0), None, None)]
    labels = {}
    for ahead in (0, 1, 21, 22):
        got = features(frame, [], failures=[(1, 1, at(ahead)), (1, 1, at(ahead))], telemetry_rows=days)
        labels[ahead] = got.first()["label"]
        assert got.count() == 1
    assert labels == {0: 0, 1: 1, 21: 1, 22: 0}
    spine = frame("equipment_id long, component_id int, date_id date", [(1, 1, at(0)), (1, 2, at(0))])
    failed = frame("equipment_id long, component_id int, failure_date date", [(1, 1, at(21)), (1, 2, at(0))])
    assert tuples(predictive.failure_labels(spine, failed), "component_id", "label") == [(1, 1), (2, 0)]


def test_latest_scores_equal_the_last_day_of_the_grid(spark):
    from fleetworks.reports import FeatureInputs
    from fleetworks.sources.testbed import Testbed

    bed = Testbed(spark, "/root/testdata/sf0.001")
    inputs = FeatureInputs(bed)
    latest = predictive.latest_scores(bed.equipment(), bed.components(), inputs.telemetry(), inputs.component_faults())
    grid = inputs.features(labelled=False)
    newest = grid.agg(F.max("date_id")).first()[0]
    columns = ["equipment_id", "component_id", "weighted_score_7d", "weighted_score_14d", "weighted_score_30d",
               "critical_count_7d"]
    assert tuples(latest, *columns) == tuples(grid.filter(F.col("date_id") == newest), *columns)


def test_split_purge_and_recency(frame):
    df = frame("date_id date, label int", [(at(n), n % 2) for n in range(10)])
    tagged = predictive.holdout_split(df, 3, purge_days=2)
    assert tuples(tagged.groupBy("split").count()) == [("test", 4), ("train", 4)]
    assert tuples(predictive.label_rates(predictive.holdout_split(df, 3)), "split", "row_count", "positives") == [
        ("test", 4, 2), ("train", 6, 3)]
    assert predictive.recent_days(df, "date_id", 2).count() == 3


def test_triage_thresholds(frame):
    df = frame("p double", [(0.7,), (0.4,), (0.69999,), (0.39999,)])
    assert [r[0] for r in df.select(predictive.triage_status(F.col("p"))).collect()] == [
        "Action Recommended", "Watch", "Watch", "New"]


def test_fault_codes_behind_a_signal(frame):
    faults = frame("equipment_id long, event_date date, fault_code string", [
        (1, at(13), "B"), (1, at(13), "A"), (1, at(12), "A"), (1, at(-1), "C")])
    bridge = frame("fault_code string, component_id int", [("A", 1), ("B", 1), ("C", 1)])
    got = predictive.contributing_fault_codes(faults, bridge, F.lit(at(13)))
    assert got.first()["contributing_fault_codes"] == ["A", "B"]


def test_rollup_and_engine_hours(frame):
    events = frame("equipment_id long, event_date date, severity string, reading double", [
        (1, at(0), "Info", 1.0), (1, at(0), "Critical", 4.0), (1, at(2), "Warning", 9.0)])
    got = telemetry.telemetry_daily_rollup(events, F.least(F.lit(24.0), F.count("*") * 0.5))
    assert tuples(got, "date_id", "engine_hours", "utilization_hours", "fault_count_info", "fault_count_warning",
                  "fault_count_critical", "avg_sensor_reading", "max_sensor_reading") == [
        (at(0), D("1.0"), D("1.0"), 1, 0, 1, D("2.500"), D("4.000")),
        (at(2), D("1.5"), D("0.5"), 0, 1, 0, D("9.000"), D("9.000"))]
    holes = frame("equipment_id long, date_id date, engine_hours double", [(1, at(0), 5.0), (1, at(1), None)])
    assert tuples(telemetry.carry_engine_hours(holes), "engine_hours") == [(5.0,), (5.0,)]


def test_calendar(frame):
    days = frame("date_id date", [(day("2024-12-29"),)])
    assert tuple(telemetry.calendar(days).first()) == (day("2024-12-29"), 2024, 4, 12, "December", 29, 7, True)
