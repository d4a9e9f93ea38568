"""The marts and the daily run over a small warehouse in CSV, as a site would have it."""

from __future__ import annotations

import csv
import datetime as dt
import json

import pytest

from fleetworks import cli
from fleetworks.plans.quality import check_constraints
from fleetworks.plans.warehouse import DailyRun, Warehouse
from fleetworks.sources import Catalog, write_table
from fleetworks.streaming import FaultLanding, TelemetryLanding
from tests.conftest import day, tuples

START = day("2024-01-01")
DAYS = 45


def at(n):
    return (START + dt.timedelta(days=n)).isoformat()


def tables():
    machines = range(1, 7)
    yield "dim_industry", "industry_id,industry_name", [(1, "Mining"), (2, "Construction")]
    yield "dim_customer", "customer_id,customer_code,customer_name,customer_type,industry_id,region,contract_tier", [
        (1, "A", "Alpha", "Owner-Operator", 1, "Western", "Platinum"), (2, "B", "Beta", "Contract Miner", 2, "Ashanti", "Gold")]
    yield "dim_site", "site_id,site_name,customer_id,region,latitude,longitude", [(1, "S", 1, "Western", 5.3, -1.9)]
    yield "dim_equipment_category", "category_id,category_name,primary_application", [(1, "Excavator", "Both")]
    yield "dim_equipment_model", "model_id,category_id,model_name,engine_series,list_price_usd", [(1, 1, "M1", "E", 1000), (2, 1, "M2", "E", 900)]
    yield "dim_equipment", "equipment_id,model_id,serial_number,customer_id,site_id,install_date,ownership_type,status", [
        (n, 1 + n % 2, f"S{n}", 1 + n % 2, 1, "2023-06-01", "Rented" if n == 6 else "Owned",
         "Decommissioned" if n == 5 else "Active") for n in machines]
    yield "dim_component", "component_id,component_name,system_category", [(1, "Pump", "Hydraulics"), (4, "Injector", "Engine")]
    yield "dim_fault_code", "fault_code,description,severity,system_category", [
        ("E-1", "low", "Warning", "Hydraulics"), ("E-2", "bad", "Critical", "Engine")]
    yield "dim_part", "part_id,part_number,part_name,part_category,unit_cost,lead_time_days", [
        (1, "P1", "Pump", "Hydraulic", 100.0, 10), (2, "P2", "Injector", "Engine", 50.0, 5)]
    yield "dim_technician", "technician_id,technician_name,branch,certification_level", [
        (1, "T1", "Tarkwa", "Certified"), (2, "T2", "Kumasi", "Certified"), (3, "T3", "Accra", "Certified")]
    yield "bridge_part_model_compatibility", "part_id,model_id", [(1, 1), (1, 2), (2, 1)]
    yield "bridge_component_part", "component_id,part_category,typical_qty,is_primary", [(1, "Hydraulic", 1, True), (4, "Engine", 2, True)]
    yield "bridge_faultcode_component", "fault_code,component_id,correlation_weight,is_direct_indicator", [
        ("E-1", 1, 0.8, True), ("E-2", 4, 0.9, True)]
    yield "fact_equipment_sales", "sale_id,equipment_id,customer_id,sale_date,sale_price,cost_basis,salesperson", [
        (n, n, 1 + n % 2, at(n * 3), 1000 + n, 800, "x") for n in range(1, 6)]
    yield "fact_rental_contracts", ("rental_id,equipment_id,customer_id,start_date,end_date,rate_type,rate,total_billed,"
                                    "actual_usage_hours"), [(1, 6, 1, at(0), "", "Monthly", 10, 20, 5.5)]
    yield "fact_telemetry_daily", ("equipment_id,date_id,engine_hours,utilization_hours,fault_count_info,fault_count_warning,"
                                   "fault_count_critical,avg_sensor_reading,max_sensor_reading"), [
        (m, at(n), 10 + 8 * n, 8.0, 0, n % 2, 1 if (n + m) % 9 == 0 else 0, 1.5, 2.5) for m in machines for n in range(DAYS)]
    # machines 1 and 2 degrade towards a failure of component 4 on days 20 and 44
    yield "fact_fault_events", "event_id,equipment_id,event_date,fault_code,severity,component_id", [
        (i, m, at(n), code, severity, 1) for i, (m, n, code, severity) in enumerate(
            [(m, n, "E-2", "Critical") for m in (1, 2) for n in (*range(10, 20), *range(30, DAYS))]
            + [(m, n, "E-1", "Warning") for m in machines for n in range(m, DAYS, 11)])]
    yield "fact_maintenance_events", (
        "work_order_id,equipment_id,customer_id,technician_id,maintenance_type,priority,source_signal_id,scheduled_date,"
        "actual_start,actual_completion,downtime_hours,sla_target_hours,labor_hours,total_cost,warranty_flag,status,root_cause,"
        "follow_up_required"), [
        (n, 1 + n % 6, 1 + (1 + n % 6) % 2, 1 + n % 3, ("Preventive", "Corrective")[n % 2], "Routine", "", at(n * 4),
         f"{at(n * 4)} 08:00:00", f"{at(n * 4)} 12:00:00", 4.0, 6, 2.0, 300.0, False, "Completed", "", False) for n in range(1, 10)]
    yield "fact_maintenance_parts_used", "work_order_id,part_id,qty_used", [(n, 1 + n % 2, 2) for n in range(1, 10)]
    yield "fact_inventory", "part_id,branch,snapshot_date,qty_on_hand,unit_cost,reorder_point,days_of_supply", [
        (p, b, at(50), 5, 100.0, 6, 9.5) for p in (1, 2) for b in ("Accra", "Kumasi")]
    yield "fact_tax_filings", ("filing_id,customer_id,period_start,period_end,vat_amount,nhil_amount,getfund_amount,"
                               "withholding_tax_amount,filing_status"), [
        (c, c, "2024-01-01", "2024-03-31", 90.0, 15.0, 15.0, 20.0, "Filed") for c in (1, 2)]
    yield "ml_maintenance_signals", (
        "signal_id,equipment_id,scoring_date,predicted_component_id,failure_probability,model_version,"
        "recommended_action_window_days,contributing_fault_codes,signal_status,dismiss_reason,created_at"), [
        (1, 1, at(44), 4, 0.9, "m", 10, "", "Action Recommended", "", "2024-02-14 00:00:00"),
        (2, 2, at(44), 4, 0.5, "m", 10, "", "Watch", "", "2024-02-14 00:00:00")]
    yield "parts_demand_forecast", "forecast_id,signal_id,equipment_id,part_id,expected_qty,is_primary,needed_by_date,demand_source", [
        (1, 1, 1, 2, 2, True, at(54), "Predictive Signal")]
    yield "parts_mapping_gaps", "gap_id,signal_id,component_id,model_id,resolved", [(1, 2, 4, 1, False)]
    yield "failure_calendar", ("calendar_id,equipment_id,component_id,event_type,window_start,failure_date,lead_window_days,midpoint,"
                               "k,false_start_cutoff,false_start_decay_days"), [
        (1, 1, 4, "Failure", at(10), at(20), 10, 0.5, 10, "", ""), (2, 2, 4, "Failure", at(10), at(21), 10, 0.5, 10, "", ""),
        (3, 1, 4, "Failure", at(30), at(44), 10, 0.5, 10, "", ""), (4, 3, 1, "FalseStart", at(3), "", 10, 0.5, 10, 0.5, 6)]


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    for name, header, rows in tables():
        with open(root / f"{name}.csv", "w", newline="") as f:
            writer = csv.writer(f)
            writer.writerow(header.split(","))
            writer.writerows(rows)
    return Catalog(spark, str(root), "csv")


def test_marts_build_and_pass_their_checks(catalog, tmp_path):
    warehouse = Warehouse(catalog)
    stored = warehouse.store(str(tmp_path))
    assert set(stored) == set(Warehouse.MARTS)
    assert {r["check_name"] for r in warehouse.check(stored).collect() if r["violations"]} == set()
    finance = stored["finance_monthly"]
    assert finance.groupBy().sum("total_revenue").first()[0] == 5015 + 20 + 2700
    assert finance.groupBy().sum("vat_amount_allocated").first()[0] == 180
    assert stored["fleet_operations"].count() == 6 and stored["parts_catalog_gaps"].count() == 1
    assert stored["predictive_maintenance"].filter("resulting_work_order_id IS NULL").count() == 2
    assert stored["warehouse_inventory"].filter("part_id = 2").first()["predictive_demand_qty"] == 2
    with pytest.raises(KeyError):
        warehouse.build("mart_of_everything")


def test_source_constraints_hold(catalog):
    names = ["dim_industry", "dim_customer", "dim_equipment_model", "dim_equipment_category", "dim_equipment", "dim_site",
             "fact_equipment_sales", "fact_rental_contracts", "fact_inventory", "bridge_faultcode_component", "dim_fault_code",
             "dim_component"]
    found = check_constraints({n: catalog.table(n) for n in names})
    assert {r["check_name"] for r in found.collect() if r["violations"]} == set()


def test_daily_run(catalog, tmp_path):
    run = DailyRun(catalog, dt.datetime(2024, 2, 15), holdout_days=10)
    assert run.features.count() == 5 * 2 * DAYS  # the decommissioned machine is out
    found, evaluation = run.score(max_iter=3)
    assert found.count() == 10 and found.select("signal_id").distinct().count() == 10
    assert 0 <= evaluation.auc <= 1 and sum(evaluation.confusion.values()) == 5 * 2 * 11
    triaged = run.triage(found)
    demand, gaps = run.resolve(triaged)
    reviewed, orders = run.convert(triaged)
    recommended = triaged.filter("signal_status = 'Action Recommended'").count()
    converted = reviewed.filter("signal_status = 'Converted'").count()
    assert orders.count() == 9 + converted
    assert demand.count() + triaged.filter("signal_status = 'Action Recommended' AND predicted_component_id = 4").join(
        catalog.table("dim_equipment").filter("model_id = 2"), "equipment_id").count() == recommended
    assert gaps.count() <= 1
    recent = DailyRun(catalog, dt.datetime(2024, 2, 15), sample_days=10, carry_hours=True)
    assert recent.features.count() == 5 * 2 * 11


def test_commands(catalog, spark, tmp_path):
    out = str(tmp_path / "out")
    base = ["--root", catalog.root, "--out", out, "--format", "csv", "--as-of", "2024-02-15"]
    cli.main(["filings", *base])
    cli.main(["inventory", *base])
    stored = Catalog(spark, out)
    filed = stored.table("fact_tax_filings")
    assert tuples(filed, "filing_id", "customer_id", "filing_status") == [(1, 1, "Pending"), (2, 2, "Pending")]
    assert stored.table("fact_inventory").count() == 8
    cli.main(["calendar", *base])
    assert stored.table("dim_date").count() == 4383
    cli.main(["score", *base, "--holdout-days", "10", "--max-iter", "2", "--now", "2024-02-15T00:00:00"])
    assert stored.table("ml_maintenance_signals").count() == 10
    assert stored.table("fact_maintenance_events").count() >= 9
    cli.main(["marts", *base])
    assert spark.read.parquet(f"{out}/maintenance_type_ratio").count() > 0


def test_landing_feeds_the_same_tables_scoring_reads(spark, catalog, tmp_path):
    topics = tmp_path / "topics"
    rows = {cli.FAULT_TOPIC: {"equipment_id": 1, "event_date": "2024-02-15", "fault_code": "E-2", "severity": "Critical"},
            cli.TELEMETRY_TOPIC: {"equipment_id": 1, "date_id": "2024-02-15", "utilization_hours": 3.0}}
    for topic, body in rows.items():
        spark.createDataFrame([("1", json.dumps(body))], "key string, value string").write.parquet(str(topics / topic))
    out = str(tmp_path / "landed")
    cli.main(["land", "--root", str(topics), "--out", out])
    assert FaultLanding(out).read(spark).count() == 1
    landed = TelemetryLanding(out).read(spark)
    assert tuples(landed, "equipment_id", "date_id", "utilization_hours") == [(1, day("2024-02-15"), 3.0)]
    # the batch side reads exactly what landed
    shared = Catalog(spark, catalog.root, "parquet", {
        "fact_telemetry_daily": TelemetryLanding(out).path, "fact_fault_events": FaultLanding(out).path})
    assert tuples(shared.table("fact_telemetry_daily"), "equipment_id", "engine_hours") == [(1, None)]
    assert tuples(shared.table("fact_fault_events"), "equipment_id", "fault_code", "event_id") == [(1, "E-2", None)]
    assert shared.table("fact_fault_events").columns == catalog.table("fact_fault_events").columns
    write_table(landed, str(tmp_path / "copy"), ["date_id"])
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 1
