from __future__ import annotations

import pytest

from fleetworks.plans import signals
from fleetworks.plans.staging import MODELS, stage
from fleetworks.sources import Catalog, append_missing, conform, literal_frame, write_csv, write_daily_csv
from fleetworks.schemas import TABLES
from tests.conftest import day, tuples


def put(tmp_path, name, text):
    (tmp_path / f"{name}.csv").write_text(text)


def test_csv_defaults_nulls_and_types(spark, tmp_path):
    put(tmp_path, "dim_part", "part_id,part_number,part_name,part_category,unit_cost,lead_time_days\n1,P,\"Oil, 205L\",C,640.0,3\n")
    put(tmp_path, "fact_rental_contracts",
        "rental_id,equipment_id,customer_id,start_date,end_date,rate_type,rate,total_billed,actual_usage_hours\n"
        "1,2,3,2024-01-01,,Monthly,10.50,21.00,\n")
    catalog = Catalog(spark, str(tmp_path), "csv")
    part = catalog.table("dim_part").first()
    assert part["supplier_id"] is None and part["part_name"] == "Oil, 205L" and str(part["unit_cost"]) == "640.00"
    contract = stage(catalog, "stg_rental_contracts").first()
    assert contract["end_date"] is None and contract["is_ongoing"] and contract["start_date"] == day("2024-01-01")
    assert stage(catalog, "stg_parts").columns == [
        "part_id", "part_number", "part_name", "part_category", "unit_cost_usd", "lead_time_days"]


def test_fault_log_scan_never_shows_the_component(spark, tmp_path):
    put(tmp_path, "fact_fault_events",
        "event_id,equipment_id,event_date,fault_code,severity,component_id\n1,2,2024-01-01,E-1,Info,7\n")
    df = Catalog(spark, str(tmp_path), "csv").table("fact_fault_events")
    assert "component_id" not in df.columns and df.first()["ingested_at"] is not None


def test_wrong_header_and_bad_values_fail_loudly(spark, tmp_path):
    put(tmp_path, "dim_industry", "industry_id,title\n1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        Catalog(spark, str(tmp_path), "csv").table("dim_industry").collect()
    put(tmp_path, "dim_component", "component_id,component_name,system_category\nabc,x,y\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        Catalog(spark, str(tmp_path), "csv").table("dim_component").collect()


def test_part_files_read_as_one_table(spark, frame, tmp_path):
    rows = frame("industry_id long, industry_name string", [(n, str(n)) for n in range(20)])
    write_csv(rows.repartition(4), str(tmp_path / "dim_industry.csv"))
    assert Catalog(spark, str(tmp_path), "csv").table("dim_industry").count() == 20


def test_registry_views_and_errors(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    with pytest.raises(KeyError):
        catalog.table("nope")
    with pytest.raises(ValueError):
        Catalog(spark, str(tmp_path), "xlsx")
    literal_frame(spark, "industry_id bigint; industry_name string", [(1, "O'Brien")]).write.parquet(str(tmp_path / "dim_industry"))
    catalog.register_views(["dim_industry"])
    assert spark.sql("SELECT industry_name FROM dim_industry").first()[0] == "O'Brien"
    assert Catalog(spark, "/none", located={"dim_industry": str(tmp_path / "dim_industry")}).table("dim_industry").count() == 1
    assert len(MODELS) == 19 and {t for t, _ in MODELS.values()} <= set(TABLES)


def test_conform(frame):
    df = conform(frame("signal_id int, contributing_fault_codes array<string>", [(1, ["A", "B"])]), "ml_maintenance_signals")
    row = df.first()
    assert row["contributing_fault_codes"] == ["A", "B"] and row["dismiss_reason"] is None and len(df.columns) == 11


def test_lists_are_text_in_csv_alone(spark, frame, tmp_path):
    rows = conform(frame("signal_id int, contributing_fault_codes array<string>", [(1, ["A", "B"]), (2, None), (3, ["C"])]),
                   "ml_maintenance_signals")
    path = str(tmp_path / "ml_maintenance_signals.csv")
    write_csv(rows, path)
    back = Catalog(spark, str(tmp_path), "csv").table("ml_maintenance_signals")
    assert back.schema == rows.schema
    assert tuples(back, "signal_id", "contributing_fault_codes") == [(1, ["A", "B"]), (2, None), (3, ["C"])]
    assert tuples(signals.fault_code_index(back)) == [("A", 1, 0), ("B", 1, 1), ("C", 3, 0)]


def test_a_day_stays_in_few_files(spark, frame, tmp_path):
    rows = frame("d date, n int", [(day(f"2024-01-0{1 + n % 3}"), n) for n in range(60)]).repartition(12)
    write_daily_csv(rows, "d", str(tmp_path / "days"))
    assert all(len(list(p.glob("part-*.csv"))) == 1 for p in (tmp_path / "days").glob("d=*"))


def test_the_least_of_several_new_rows_is_taken(frame):
    new = frame("k int, v string, w int", [(1, "b", 1), (1, "a", 9), (1, "a", 3), (2, "x", 1)])
    got = append_missing(new, frame("k int, v string, w int", [(2, "old", 0)]), ["k"])
    assert tuples(got) == [(1, "a", 3), (2, "old", 0)]
