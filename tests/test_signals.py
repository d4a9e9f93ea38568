from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetworks import constants as C
from fleetworks.plans import signals
from tests.conftest import day, tuples

BASE = day("2024-01-01")
SIGNAL = ("signal_id long, equipment_id long, scoring_date date, predicted_component_id int, failure_probability double,"
          " recommended_action_window_days int, signal_status string, dismiss_reason string")
ACTION = "Action Recommended"


def at(n):
    return BASE + dt.timedelta(days=n)


def signal(n, status, equipment=1, component=1, window=10, p=0.8):
    return (n, equipment, BASE, component, p, window, status, None)


def world(frame):
    machines = frame("equipment_id long, model_id long, customer_id long", [(1, 7, 1), (2, 7, 2), (3, 8, 3), (4, 8, None)])
    people = frame("customer_id long, contract_tier string", [(1, "Platinum"), (2, "Gold"), (3, "Platinum")])
    return machines, people


def triage(frame, rows, orders):
    machines, people = world(frame)
    booked = frame("equipment_id long, scheduled_date date, status string", orders)
    return tuples(signals.apply_triage(frame(SIGNAL, rows), machines, people, booked), "signal_id", "signal_status",
                  "dismiss_reason")


def test_dismissal_comes_before_escalation(frame):
    got = triage(frame, [signal(1, "Watch"), signal(2, "Watch", equipment=3), signal(3, "New"), signal(4, ACTION),
                         signal(5, "Watch", equipment=2)], [(1, at(10), "Scheduled")])
    assert got == [(1, "Dismissed", C.DUPLICATE_REASON), (2, ACTION, None), (3, "New", None),
                   (4, "Dismissed", C.DUPLICATE_REASON), (5, "Watch", None)]


def test_only_open_orders_inside_the_window_count(frame):
    orders = [(1, at(11), "Scheduled"), (1, at(-1), "Scheduled"), (1, at(5), "Completed"), (2, at(0), "Scheduled")]
    assert triage(frame, [signal(1, ACTION), signal(2, ACTION, equipment=2)], orders) == [
        (1, ACTION, None), (2, "Dismissed", C.DUPLICATE_REASON)]


def test_long_windows_do_not_escalate(frame):
    assert triage(frame, [signal(1, "Watch", window=11), signal(2, "Watch", equipment=4)], []) == [
        (1, "Watch", None), (2, "Watch", None)]


def catalog(frame):
    machines, _ = world(frame)
    wanted = frame("component_id int, part_category string, typical_qty int, is_primary boolean", [
        (1, "Pump", 1, True), (1, "Seal", 2, False), (2, "Missing", 1, True)])
    fits = frame("part_id long, model_id long", [(10, 7), (11, 7), (12, 8)])
    parts = frame("part_id long, part_category string", [(10, "Pump"), (11, "Pump"), (12, "Seal"), (13, "Seal")])
    return machines, wanted, fits, parts


def test_parts_resolution_and_gaps(frame):
    rows = frame(SIGNAL, [
        signal(1, ACTION), signal(2, ACTION), signal(3, ACTION, component=2), signal(4, ACTION, component=9),
        signal(5, "Watch", component=2), signal(6, ACTION, equipment=3), signal(7, ACTION, component=9)])
    demand = signals.parts_demand(rows, *catalog(frame))
    assert tuples(demand, "forecast_id", "signal_id", "part_id", "expected_qty", "is_primary", "needed_by_date") == [
        (1, 1, 10, 1, True, at(10)), (2, 2, 10, 1, True, at(10)), (3, 6, 12, 2, False, at(10))]
    gaps = signals.parts_gaps(rows, *catalog(frame))
    # signals 1 and 2 meet the same missing seal; 4 and 7 the same unmapped component
    assert tuples(gaps, "gap_id", "signal_id", "component_id", "model_id", "resolved") == [
        (1, 1, 1, 7, False), (2, 3, 2, 7, False), (3, 4, 9, 7, False), (4, 6, 1, 8, False)]


def test_review_is_repeatable_and_near_its_rate(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("signal_id"), F.lit(ACTION).alias("signal_status"), F.lit(None).cast("string").alias("dismiss_reason"))
    reviewed = signals.review_signals(rows)
    share = reviewed.filter("signal_status = 'Dismissed'").count() / 5000
    assert abs(share - 0.15) < 0.02
    assert {r[0] for r in reviewed.select("dismiss_reason").distinct().collect()} == {None, *C.ADVISOR_REASONS}
    assert tuples(reviewed) == tuples(signals.review_signals(rows.repartition(7)))


def test_new_orders(frame, spark):
    machines, people = world(frame)
    rows = frame(SIGNAL, [signal(n, "Converted", equipment=1 + n % 4, p=0.9 if n % 2 else 0.7) for n in range(1, 41)])
    technicians = frame("technician_id long, branch string", [(1, "Accra"), (2, "Accra"), (3, "Tarkwa")])
    orders = signals.predictive_work_orders(
        rows, machines, people, technicians, {1: "Tarkwa", 2: "Nowhere"}, F.lit(100)).cache()
    assert [r[0] for r in orders.select("work_order_id").orderBy("work_order_id").collect()] == list(range(101, 141))
    by_customer = {c: {r["technician_id"] for r in orders.filter(cond).collect()} for c, cond in (
        ("tarkwa", "customer_id = 1"), ("nowhere", "customer_id = 2"), ("default", "customer_id = 3"),
        ("none", "customer_id IS NULL"))}
    assert by_customer["tarkwa"] == {3} and by_customer["default"] <= {1, 2} and by_customer["none"] <= {1, 2}
    assert by_customer["nowhere"] <= {1, 2, 3} and by_customer["nowhere"]
    late = orders.withColumn("offset", F.datediff("scheduled_date", F.lit(BASE))).agg(F.min("offset"), F.max("offset")).first()
    assert late[0] >= 1 and late[1] <= 8
    top = orders.filter("customer_id = 1").agg(F.max(F.datediff("scheduled_date", F.lit(BASE)))).first()[0]
    assert top <= 4  # half the window for the top tier
    hours = {r["customer_id"]: float(r["sla_target_hours"]) for r in orders.collect()}
    assert hours == {1: 6, 2: 12, 3: 6, None: 48}
    assert {r["priority"] for r in orders.filter("source_signal_id % 2 = 1").collect()} == {"Critical"}
    whole = signals.append_work_orders(frame("work_order_id long, root_cause string", [(100, "wear")]), orders)
    assert whole.count() == 41 and whole.filter("root_cause IS NULL").count() == 40


def test_window_of_one_day_still_books_tomorrow(frame):
    machines, people = world(frame)
    rows = frame(SIGNAL, [signal(1, "Converted", window=1), signal(2, "Converted", equipment=2, window=2)])
    technicians = frame("technician_id long, branch string", [(1, "Accra")])
    orders = signals.predictive_work_orders(rows, machines, people, technicians, {}, F.lit(0))
    assert {r["scheduled_date"] for r in orders.collect()} == {at(1)}


def test_outcomes_visits_and_expiry(frame):
    rows = frame(SIGNAL, [signal(1, ACTION), signal(2, ACTION, component=2), signal(3, ACTION, equipment=2, window=13),
                          signal(4, ACTION, equipment=1, component=3, window=14), signal(5, "Converted")])
    failures = frame("equipment_id long, component_id int, failure_date date", [(1, 1, at(4)), (1, 2, at(30))])
    orders = frame("work_order_id long, source_signal_id long", [(9, 1), (8, 1)])
    outcomes = signals.signal_outcomes(rows.filter("signal_id < 4"), failures, orders, F.lit(at(60)))
    assert tuples(outcomes) == [(1, "Confirmed Failure", 4, 8), (2, "False Positive", None, None),
                                (3, "False Positive", None, None)]
    precision = signals.outcome_precision(outcomes).first()
    assert precision["confirmed"] == 1 and abs(precision["precision"] - 1 / 3) < 1e-9
    # windows still open on the last observed day are undecided, and a failure on the signal's own day is none
    early = signals.signal_outcomes(rows.filter("signal_id < 4"), failures.withColumn(
        "failure_date", F.when(F.col("component_id") == 1, F.lit(at(0))).otherwise(F.col("failure_date"))), orders, F.lit(at(1)))
    assert [r["actual_outcome"] for r in early.collect()] == [None] * 3
    undecided = signals.outcome_precision(early).first()
    assert (undecided["signals"], undecided["decided"], undecided["precision"]) == (3, 0, None)
    assert tuples(signals.merge_into_visits(rows, 3), "signal_id", "visit_no") == [(1, 1), (2, 1), (3, 1), (4, 2)]
    aged = signals.expire_signals(rows, F.lit(at(12)))
    assert tuples(aged.filter("signal_status = 'Expired'"), "signal_id") == [(1,), (2,)]


def test_gap_summary_orders_by_count(frame):
    gaps = frame("model_id long, model_name string, category_name string, component_id int, component_name string,"
                 " system_category string, resolved boolean, scoring_date date",
                 [(1, "m", "c", 1, "p", "s", True, at(0)), (2, "m", "c", 1, "p", "s", False, at(1)),
                  (2, "m", "c", 1, "p", "s", True, at(3))])
    got = [(r["model_id"], r["total_gaps"], r["unresolved_gaps"], r["first_seen"], r["last_seen"])
           for r in signals.catalog_gaps_summary(gaps).collect()]
    assert got == [(2, 2, 1, at(1), at(3)), (1, 1, 0, at(0), at(0))]
