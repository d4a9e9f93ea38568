"""Table schemas as DDL, the columns each CSV carries, and the declared constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from fleetworks import constants as C

TABLES: dict[str, str] = {
    "dim_industry": "industry_id BIGINT, industry_name STRING",
    "dim_customer": "customer_id BIGINT, customer_code STRING, customer_name STRING, customer_type STRING, "
                    "industry_id BIGINT, region STRING, contract_tier STRING, created_at TIMESTAMP",
    "dim_site": "site_id BIGINT, site_name STRING, customer_id BIGINT, region STRING, "
                "latitude DECIMAL(9,6), longitude DECIMAL(9,6)",
    "dim_equipment_category": "category_id BIGINT, category_name STRING, primary_application STRING",
    "dim_equipment_model": "model_id BIGINT, category_id BIGINT, model_name STRING, engine_series STRING, "
                           "list_price_usd DECIMAL(14,2)",
    "dim_equipment": "equipment_id BIGINT, model_id BIGINT, serial_number STRING, customer_id BIGINT, site_id BIGINT, "
                     "install_date DATE, ownership_type STRING, status STRING",
    "dim_component": "component_id BIGINT, component_name STRING, system_category STRING",
    "dim_fault_code": "fault_code STRING, description STRING, severity STRING, system_category STRING",
    "dim_part": "part_id BIGINT, part_number STRING, part_name STRING, part_category STRING, "
                "unit_cost DECIMAL(12,2), supplier_id BIGINT, lead_time_days INT",
    "dim_technician": "technician_id BIGINT, technician_name STRING, branch STRING, certification_level STRING",
    "dim_date": "date_id DATE, year INT, quarter INT, month INT, month_name STRING, day INT, day_of_week INT, "
                "is_weekend BOOLEAN",
    "bridge_part_model_compatibility": "part_id BIGINT, model_id BIGINT",
    "bridge_component_part": "component_id BIGINT, part_category STRING, typical_qty INT, is_primary BOOLEAN",
    "bridge_faultcode_component": "fault_code STRING, component_id BIGINT, correlation_weight DECIMAL(4,3), "
                                  "is_direct_indicator BOOLEAN",
    "fact_equipment_sales": "sale_id BIGINT, equipment_id BIGINT, customer_id BIGINT, sale_date DATE, "
                            "sale_price DECIMAL(14,2), cost_basis DECIMAL(14,2), salesperson STRING",
    "fact_rental_contracts": "rental_id BIGINT, equipment_id BIGINT, customer_id BIGINT, start_date DATE, end_date DATE, "
                             "rate_type STRING, rate DECIMAL(12,2), total_billed DECIMAL(14,2), "
                             "actual_usage_hours DECIMAL(10,1)",
    "fact_telemetry_daily": "equipment_id BIGINT, date_id DATE, engine_hours DECIMAL(6,1), "
                            "utilization_hours DECIMAL(5,1), fault_count_info INT, fault_count_warning INT, "
                            "fault_count_critical INT, avg_sensor_reading DECIMAL(10,3), "
                            "max_sensor_reading DECIMAL(10,3)",
    "fact_fault_events": "event_id BIGINT, equipment_id BIGINT, event_date DATE, fault_code STRING, severity STRING, "
                         "ingested_at TIMESTAMP",
    "fact_maintenance_events": "work_order_id BIGINT, equipment_id BIGINT, customer_id BIGINT, technician_id BIGINT, "
                               "maintenance_type STRING, priority STRING, source_signal_id BIGINT, "
                               "scheduled_date DATE, actual_start TIMESTAMP, actual_completion TIMESTAMP, "
                               "downtime_hours DECIMAL(6,1), sla_target_hours DECIMAL(6,1), "
                               "labor_hours DECIMAL(6,1), total_cost DECIMAL(12,2), warranty_flag BOOLEAN, "
                               "status STRING, root_cause STRING, follow_up_required BOOLEAN",
    "fact_maintenance_parts_used": "work_order_id BIGINT, part_id BIGINT, qty_used INT",
    "fact_inventory": "part_id BIGINT, branch STRING, snapshot_date DATE, qty_on_hand INT, "
                      "unit_cost DECIMAL(12,2), reorder_point INT, days_of_supply DECIMAL(6,1)",
    "fact_tax_filings": "filing_id BIGINT, customer_id BIGINT, period_start DATE, period_end DATE, "
                        "vat_amount DECIMAL(14,2), nhil_amount DECIMAL(14,2), getfund_amount DECIMAL(14,2), "
                        "withholding_tax_amount DECIMAL(14,2), filing_status STRING",
    "ml_maintenance_signals": "signal_id BIGINT, equipment_id BIGINT, scoring_date DATE, predicted_component_id BIGINT, "
                              "failure_probability DECIMAL(5,4), model_version STRING, "
                              "recommended_action_window_days INT, contributing_fault_codes ARRAY<STRING>, "
                              "signal_status STRING, dismiss_reason STRING, created_at TIMESTAMP",
    "parts_demand_forecast": "forecast_id BIGINT, signal_id BIGINT, equipment_id BIGINT, part_id BIGINT, expected_qty INT, "
                             "is_primary BOOLEAN, needed_by_date DATE, demand_source STRING",
    "parts_mapping_gaps": "gap_id BIGINT, signal_id BIGINT, component_id BIGINT, model_id BIGINT, logged_at TIMESTAMP, "
                          "resolved BOOLEAN",
    "signal_outcomes": "signal_id BIGINT, actual_outcome STRING, lead_time_delivered_days INT, "
                       "resulting_work_order_id BIGINT",
    "failure_calendar": "calendar_id BIGINT, equipment_id BIGINT, component_id BIGINT, event_type STRING, "
                        "window_start DATE, failure_date DATE, lead_window_days INT, midpoint DOUBLE, k DOUBLE, "
                        "false_start_cutoff DOUBLE, false_start_decay_days INT",
}

# Columns that exist in the table but not in its CSV; the loader fills them with the default, or NULL.
CSV_ABSENT: dict[str, dict[str, str | None]] = {
    "dim_customer": {"created_at": "current_timestamp()"},
    "dim_part": {"supplier_id": None},
    "parts_mapping_gaps": {"logged_at": "current_timestamp()"},
    "fact_fault_events": {"ingested_at": "current_timestamp()"},
}

# Columns a CSV carries in the middle of its header that the table must never see.
# The fault log names the component that caused each event; a model reading it would know the answer.
CSV_EXCLUDED: dict[str, str] = {"fact_fault_events": "component_id BIGINT"}

# Message payloads on the two telemetry topics
FAULT_MESSAGE = "equipment_id BIGINT, event_date STRING, fault_code STRING, severity STRING"
TELEMETRY_MESSAGE = (
    "equipment_id BIGINT, date_id STRING, utilization_hours DOUBLE, fault_count_info INT, "
    "fault_count_warning INT, fault_count_critical INT, avg_sensor_reading DOUBLE, max_sensor_reading DOUBLE"
)


@dataclass(frozen=True)
class Constraints:
    """What must hold for one table. Row rules are SQL conditions that are true for a *violating* row."""

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    allowed: dict[str, list[str]] = field(default_factory=dict)
    rules: dict[str, str] = field(default_factory=dict)


_EQUIPMENT = ("dim_equipment", "equipment_id")
_CUSTOMER = ("dim_customer", "customer_id")
_COMPONENT = ("dim_component", "component_id")
_MODEL = ("dim_equipment_model", "model_id")
_PART = ("dim_part", "part_id")
_SIGNAL = ("ml_maintenance_signals", "signal_id")
_ORDER = ("fact_maintenance_events", "work_order_id")

CONSTRAINTS: dict[str, Constraints] = {
    "dim_industry": Constraints(("industry_id",), ("industry_name",), (("industry_name",),)),
    "dim_customer": Constraints(
        ("customer_id",), ("customer_code", "customer_name", "customer_type", "industry_id", "region"),
        (("customer_code",),), {"industry_id": ("dim_industry", "industry_id")},
        {"customer_type": C.CUSTOMER_TYPES, "contract_tier": C.TIERS}),
    "dim_site": Constraints(("site_id",), ("site_name", "customer_id", "region"), (), {"customer_id": _CUSTOMER}),
    "dim_equipment_category": Constraints(
        ("category_id",), ("category_name", "primary_application"), (("category_name",),), {},
        {"primary_application": C.APPLICATIONS}),
    "dim_equipment_model": Constraints(
        ("model_id",), ("category_id", "model_name"), (("category_id", "model_name"),),
        {"category_id": ("dim_equipment_category", "category_id")}),
    "dim_equipment": Constraints(
        ("equipment_id",), ("model_id", "serial_number", "ownership_type", "status"), (("serial_number",),),
        {"model_id": _MODEL, "customer_id": _CUSTOMER, "site_id": ("dim_site", "site_id")},
        {"ownership_type": C.OWNERSHIP_TYPES, "status": C.EQUIPMENT_STATUSES}),
    "dim_component": Constraints(
        ("component_id",), ("component_name", "system_category"), (("component_name",),), {},
        {"system_category": C.SYSTEM_CATEGORIES}),
    "dim_fault_code": Constraints(
        ("fault_code",), ("description", "severity", "system_category"), (), {}, {"severity": C.SEVERITIES}),
    "dim_part": Constraints(
        ("part_id",), ("part_number", "part_name", "part_category", "unit_cost"), (("part_number",),)),
    "dim_technician": Constraints(
        ("technician_id",), ("technician_name", "branch"), (), {}, {"branch": C.BRANCHES}),
    "dim_date": Constraints(
        ("date_id",), ("year", "quarter", "month", "month_name", "day", "day_of_week", "is_weekend")),
    "bridge_part_model_compatibility": Constraints(
        ("part_id", "model_id"), (), (), {"part_id": _PART, "model_id": _MODEL}),
    "bridge_component_part": Constraints(
        ("component_id", "part_category"), ("typical_qty", "is_primary"), (), {"component_id": _COMPONENT}),
    "bridge_faultcode_component": Constraints(
        ("fault_code", "component_id"), ("correlation_weight", "is_direct_indicator"), (),
        {"fault_code": ("dim_fault_code", "fault_code"), "component_id": _COMPONENT}, {},
        {"correlation_weight between 0 and 1": "correlation_weight NOT BETWEEN 0 AND 1"}),
    "fact_equipment_sales": Constraints(
        ("sale_id",), ("equipment_id", "customer_id", "sale_date", "sale_price", "cost_basis"), (),
        {"equipment_id": _EQUIPMENT, "customer_id": _CUSTOMER, "sale_date": ("dim_date", "date_id")}),
    "fact_rental_contracts": Constraints(
        ("rental_id",), ("equipment_id", "customer_id", "start_date", "rate_type", "rate", "total_billed"), (),
        {"equipment_id": _EQUIPMENT, "customer_id": _CUSTOMER}, {"rate_type": C.RATE_TYPES}),
    "fact_telemetry_daily": Constraints(
        ("equipment_id", "date_id"), ("fault_count_info", "fault_count_warning", "fault_count_critical"), (),
        {"equipment_id": _EQUIPMENT, "date_id": ("dim_date", "date_id")}),
    "fact_fault_events": Constraints(
        ("event_id",), ("equipment_id", "event_date", "fault_code", "severity"), (),
        {"equipment_id": _EQUIPMENT, "fault_code": ("dim_fault_code", "fault_code")},
        {"severity": C.SEVERITIES}),
    "fact_maintenance_events": Constraints(
        ("work_order_id",),
        ("equipment_id", "customer_id", "maintenance_type", "priority", "scheduled_date", "warranty_flag",
         "status", "follow_up_required"), (),
        {"equipment_id": _EQUIPMENT, "customer_id": _CUSTOMER,
         "technician_id": ("dim_technician", "technician_id"), "source_signal_id": _SIGNAL},
        {"maintenance_type": C.MAINTENANCE_TYPES, "priority": C.PRIORITIES, "status": C.WORK_ORDER_STATUSES}),
    "fact_maintenance_parts_used": Constraints(
        ("work_order_id", "part_id"), ("qty_used",), (), {"work_order_id": _ORDER, "part_id": _PART}),
    "fact_inventory": Constraints(
        ("part_id", "branch", "snapshot_date"), ("qty_on_hand", "unit_cost", "reorder_point"), (),
        {"part_id": _PART}, {"branch": C.BRANCHES}),
    "fact_tax_filings": Constraints(
        ("filing_id",), ("customer_id", "period_start", "period_end", "vat_amount", "nhil_amount",
                         "getfund_amount", "withholding_tax_amount", "filing_status"), (),
        {"customer_id": _CUSTOMER}, {"filing_status": C.FILING_STATUSES}),
    "ml_maintenance_signals": Constraints(
        ("signal_id",), ("equipment_id", "scoring_date", "predicted_component_id", "failure_probability",
                         "model_version", "signal_status"), (),
        {"equipment_id": _EQUIPMENT, "predicted_component_id": _COMPONENT},
        {"signal_status": C.SIGNAL_STATUSES},
        {"failure_probability between 0 and 1": "failure_probability NOT BETWEEN 0 AND 1"}),
    "parts_demand_forecast": Constraints(
        ("forecast_id",), ("equipment_id", "part_id", "expected_qty", "is_primary", "demand_source"), (),
        {"signal_id": _SIGNAL, "equipment_id": _EQUIPMENT, "part_id": _PART}, {"demand_source": C.DEMAND_SOURCES}),
    "parts_mapping_gaps": Constraints(
        ("gap_id",), ("resolved",), (), {"signal_id": _SIGNAL, "component_id": _COMPONENT, "model_id": _MODEL}),
    "signal_outcomes": Constraints(
        ("signal_id",), ("actual_outcome",), (),
        {"signal_id": _SIGNAL, "resulting_work_order_id": _ORDER}, {"actual_outcome": C.OUTCOMES}),
}
