from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from fleetworks.plans import inventory, service, staging
from tests.conftest import day, tuples

BASE = day("2024-01-01")
ORDER = ("work_order_id long, equipment_id long, technician_id long, maintenance_type string, scheduled_date date,"
         " actual_start timestamp, actual_completion timestamp, downtime_hours decimal(6,1), sla_target_hours decimal(6,1),"
         " status string, source_signal_id long")


def at(n):
    return BASE + dt.timedelta(days=n)


def order(n, kind="Corrective", when=0, hours=None, target=6, status="Completed", technician=1, machine=1, signal=None):
    start = dt.datetime(2024, 1, 1, 8)
    end = start + dt.timedelta(hours=hours) if hours is not None else None
    down = D(str(hours)) if hours is not None else None
    return (n, machine, technician, kind, at(when), start, end, down, D(target), status, signal)


def test_branch_performance(frame):
    orders = frame(ORDER, [
        order(1, hours=6), order(2, "Preventive", hours=6.5), order(3, "Inspection"), order(4, hours=1, status="Scheduled"),
        order(5, "Predictive", when=40), order(6, hours=1, technician=99), order(7, hours=1, technician=None)])
    crew = frame("technician_id long, branch string", [(1, "Accra"), (2, "Kumasi")])
    got = {(r["branch"], r["period_month"]): r for r in service.branch_performance(orders, crew).collect()}
    accra = got["Accra", at(0)]
    assert (accra["work_order_count"], accra["corrective_count"], accra["preventive_count"], accra["inspection_count"]) == (3, 1, 1, 1)
    assert (accra["sla_measurable_count"], accra["sla_met_count"], accra["sla_compliance_pct"]) == (2, 1, D("50.0"))
    assert accra["avg_downtime_hours"] == D("6.25") and accra["active_technicians"] == 1
    assert got["Accra", day("2024-02-01")]["sla_compliance_pct"] is None
    assert got[None, at(0)]["work_order_count"] == 2


def test_type_ratio(frame):
    orders = staging.maintenance_events(frame(ORDER, [order(1), order(2, signal=5), order(3, status="Scheduled")]))
    assert tuples(service.maintenance_type_ratio(orders), "maintenance_type", "is_predictive_sourced", "work_order_count") == [
        ("Corrective", False, 1), ("Corrective", True, 1)]


def test_fleet_reliability(frame):
    machines = frame("equipment_id long, model_id long, serial_number string, customer_id long, install_date date,"
                     " ownership_type string, status string", [(1, 1, "a", 1, at(0), "Owned", "Active"),
                                                               (2, 9, "b", None, at(0), "Rented", "Idle")])
    models = frame("model_id long, category_id long, model_name string", [(1, 1, "M")])
    categories = frame("category_id long, category_name string, primary_application string", [(1, "C", "Both")])
    people = frame("customer_id long, customer_name string, customer_type string, region string", [(1, "n", "t", "r")])
    telemetry = frame("equipment_id long, utilization_hours decimal(5,1), engine_hours decimal(6,1), fault_count_critical int",
                      [(1, D("2.0"), D("5.0"), 1), (1, D("3.0"), D("9.0"), 2)])
    orders = frame(ORDER, [order(1, when=0, hours=4), order(2, when=0, hours=2), order(3, when=9), order(4, "Preventive", 3, 8),
                           order(5, when=99, status="Scheduled")])
    rentals = frame("equipment_id long, total_billed decimal(14,2), actual_usage_hours decimal(10,1)", [(2, D(5), D(1)), (2, D(6), None)])
    fleet = service.fleet_operations(machines, models, categories, people, telemetry, orders, rentals)
    one, two = fleet.orderBy("equipment_id").collect()
    assert (float(one["avg_daily_utilization_hours"]), one["latest_engine_hours"], one["total_critical_faults"]) == (2.5, D("9.0"), 3)
    assert (one["corrective_count"], float(one["avg_mttr_hours"]), one["total_downtime_hours"]) == (3, 3.0, D("14.0"))
    assert float(one["mtbf_days"]) == 4.5 and one["last_service_date"] == at(9)  # gaps 0 and 9
    assert two["model_name"] is None and two["mtbf_days"] is None and two["total_rental_billed"] == D("11.00")
    # the same mean from the ordered gaps
    gaps = service.corrective_gaps(orders).collect()
    steps = [r["days_since_prior_corrective"] for r in gaps if r["days_since_prior_corrective"] is not None]
    repeats = sum(r["n"] - 1 for r in gaps)
    assert sum(steps) / (len(steps) + repeats) == 4.5
    assert {r["ownership_type"]: r["machines"] for r in service.ownership_split(fleet).collect()} == {"Owned": 1, "Rented": 1}


def test_costing_and_warranty(frame):
    orders = frame("work_order_id long, equipment_id long, scheduled_date date, labor_hours decimal(6,1)", [
        (1, 1, at(730), D("2.0")), (2, 1, at(731), None)])
    used = frame("work_order_id long, part_id long, qty_used int", [(1, 1, 2), (1, 2, 1)])
    parts = frame("part_id long, unit_cost_usd decimal(12,2)", [(1, D("10.00")), (2, D("0.05"))])
    machines = frame("equipment_id long, install_date date", [(1, at(0))])
    got = service.work_order_costing(orders, used, parts, machines)
    assert tuples(got, "work_order_id", "parts_cost", "labour_cost", "total_cost", "warranty_eligible") == [
        (1, D("228.57"), D("360.00"), D("588.57"), True), (2, D("0.00"), D("0.00"), D("0.00"), False)]


STOCK = ("part_id long, branch string, snapshot_date date, qty_on_hand int, unit_cost decimal(12,2), reorder_point int,"
         " days_of_supply decimal(6,1)")
PARTS = "part_id long, part_number string, part_name string, part_category string"
USED = "part_id long, customer_id long, scheduled_date date, qty_used int"
FORECAST = "part_id long, expected_qty int, demand_source string"


def warehouse(frame, integer_division=False):
    snapshot = at(400)
    stock = staging.inventory(frame(STOCK, [
        (n, "Accra", snapshot, 0 if n == 4 else 10, D(3), 11 if n == 1 else 5, None) for n in (1, 2, 3, 4)]))
    used = frame(USED, [(1, 1, at(220), 40), (2, 1, at(219), 40), (4, 1, at(219), 1), (1, 1, at(20), 60)])
    demand = frame(FORECAST, [(1, 3, "Predictive Signal"), (1, 4, "Predictive Signal"), (1, 9, "Historical Baseline")])
    parts = frame(PARTS, [(1, "p", "n", "c")])
    out = inventory.warehouse_inventory(stock, parts, used, demand, integer_division)
    return {r["part_id"]: r for r in out.collect()}


def test_dead_stock_edges(frame):
    rows = warehouse(frame)
    assert {n: r["is_dead_stock"] for n, r in rows.items()} == {1: False, 2: True, 3: True, 4: False}
    assert {n: r["days_since_last_consumption"] for n, r in rows.items()} == {1: 180, 2: 181, 3: None, 4: 181}
    assert rows[2]["dead_stock_value"] == 30 and rows[1]["dead_stock_value"] == 0
    assert rows[1]["is_below_reorder_point"] and rows[2]["part_name"] is None
    assert (rows[1]["predictive_demand_signals"], rows[1]["predictive_demand_qty"], rows[2]["predictive_demand_qty"]) == (2, 7, 0)


def test_turnover_annualises_over_the_whole_span(frame):
    rows = warehouse(frame)
    assert float(rows[1]["annualized_consumption"]) == 182.5  # 100 over 200 days
    assert rows[1]["inventory_turnover_ratio"] == D("18.25") and rows[4]["inventory_turnover_ratio"] is None
    truncated = warehouse(frame, integer_division=True)
    assert truncated[1]["annualized_consumption"] == 0


def test_replenishment_splits_and_floors(frame):
    parts = frame("part_id long, unit_cost_usd decimal(12,2), lead_time_days int", [(1, D("1.00"), 10), (2, D("2.00"), 10)])
    used = frame("part_id long, branch string, qty_used int", [(1, "A", 60), (1, "A", 40)])
    orders = frame("scheduled_date date", [(at(0),), (at(10),), (at(4),)])
    history = inventory.history_days(orders)
    branches = F.array(F.lit("A"), F.lit("B"))
    got = {(r["part_id"], r["branch"]): r for r in inventory.inventory_replenishment(
        parts, used, history, branches, at(20), cover_days=20, safety=1.5).collect()}
    assert len(got) == 4
    a, b = got[1, "A"], got[1, "B"]
    assert (a["qty_on_hand"], b["qty_on_hand"]) == (198, 2) and (a["reorder_point"], b["reorder_point"]) == (149, 1)
    assert a["unit_cost"] == D("11.40") and a["days_of_supply"] == 19.8
    elsewhere = used.unionByName(frame("part_id long, branch string, qty_used int", [(1, None, 100)]))
    more = inventory.inventory_replenishment(parts, elsewhere, history, branches, at(20), cover_days=20, safety=1.5)
    # use outside the branches raises the part's total but not the split
    assert more.filter("part_id = 1").groupBy().sum("qty_on_hand").first()[0] == 400
    idle = got[2, "A"]
    assert (idle["qty_on_hand"], idle["reorder_point"]) == (0, 1)  # half of one, to the even neighbour


def test_baseline_and_risk(frame):
    used = frame(USED, [(1, 1, at(0), 5), (1, 1, at(10), 6)])
    assert tuples(inventory.baseline_demand(used, 30), "part_id", "expected_qty") == [(1, 33)]
    forecast = frame("part_id long, expected_qty int, is_primary boolean, needed_by_date date, demand_source string", [
        (1, 3, True, at(5), "Predictive Signal"), (1, 3, True, at(4), "Predictive Signal"),
        (2, 1, True, at(4), "Predictive Signal"), (3, 9, False, at(4), "Predictive Signal")])
    stock = frame("part_id long, branch string, qty_on_hand int", [(1, "A", 2), (1, "B", 3), (2, "A", 1)])
    assert tuples(inventory.parts_at_risk(forecast, stock)) == [(1, 6, 2, at(4), 5)]
