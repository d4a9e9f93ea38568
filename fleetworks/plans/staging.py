"""Staging models: one function per raw table, renaming and deriving columns and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetworks.sources.catalog import Catalog


def _plain(raw: DataFrame, *drop: str) -> DataFrame:
    return raw.drop(*drop)


def industries(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def customers(raw: DataFrame) -> DataFrame:
    return _plain(raw, "created_at")


def sites(raw: DataFrame) -> DataFrame:
    """Sites keep their coordinates."""
    return _plain(raw)


def equipment(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def equipment_models(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def equipment_categories(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def components(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def parts(raw: DataFrame) -> DataFrame:
    """The catalogue cost is a US-dollar reference; only inventory carries the local-currency cost."""
    return raw.withColumnRenamed("unit_cost", "unit_cost_usd").drop("supplier_id")


def technicians(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def equipment_sales(raw: DataFrame) -> DataFrame:
    return raw.withColumn("margin", F.col("sale_price") - F.col("cost_basis"))


def rental_contracts(raw: DataFrame) -> DataFrame:
    return raw.withColumn("is_ongoing", F.col("end_date").isNull())


def maintenance_events(raw: DataFrame) -> DataFrame:
    return raw.withColumn("is_predictive_sourced", F.col("source_signal_id").isNotNull())


def maintenance_parts_used(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def telemetry_daily(raw: DataFrame) -> DataFrame:
    faults = F.col("fault_count_info") + F.col("fault_count_warning") + F.col("fault_count_critical")
    return raw.withColumn("fault_count_total", faults)


def inventory(raw: DataFrame) -> DataFrame:
    return (
        raw.withColumnRenamed("unit_cost", "unit_cost_ghs")
        .withColumn("inventory_value_ghs", F.col("qty_on_hand") * F.col("unit_cost_ghs"))
        .withColumn("is_below_reorder_point", F.col("qty_on_hand") < F.col("reorder_point"))
    )


def tax_filings(raw: DataFrame) -> DataFrame:
    output_tax = F.col("vat_amount") + F.col("nhil_amount") + F.col("getfund_amount")
    return raw.withColumn("total_output_tax", output_tax)


def ml_signals(raw: DataFrame) -> DataFrame:
    """Signals keep the fault codes behind them."""
    return _plain(raw)


def parts_demand_forecast(raw: DataFrame) -> DataFrame:
    return _plain(raw)


def parts_mapping_gaps(raw: DataFrame) -> DataFrame:
    return _plain(raw, "logged_at")


MODELS = {
    "stg_industries": ("dim_industry", industries),
    "stg_customers": ("dim_customer", customers),
    "stg_sites": ("dim_site", sites),
    "stg_equipment": ("dim_equipment", equipment),
    "stg_equipment_models": ("dim_equipment_model", equipment_models),
    "stg_equipment_categories": ("dim_equipment_category", equipment_categories),
    "stg_components": ("dim_component", components),
    "stg_parts": ("dim_part", parts),
    "stg_technicians": ("dim_technician", technicians),
    "stg_equipment_sales": ("fact_equipment_sales", equipment_sales),
    "stg_rental_contracts": ("fact_rental_contracts", rental_contracts),
    "stg_maintenance_events": ("fact_maintenance_events", maintenance_events),
    "stg_maintenance_parts_used": ("fact_maintenance_parts_used", maintenance_parts_used),
    "stg_telemetry_daily": ("fact_telemetry_daily", telemetry_daily),
    "stg_inventory": ("fact_inventory", inventory),
    "stg_tax_filings": ("fact_tax_filings", tax_filings),
    "stg_ml_signals": ("ml_maintenance_signals", ml_signals),
    "stg_parts_demand_forecast": ("parts_demand_forecast", parts_demand_forecast),
    "stg_parts_mapping_gaps": ("parts_mapping_gaps", parts_mapping_gaps),
}


def stage(catalog: Catalog, model: str) -> DataFrame:
    """A staging model over the catalog's raw table. Lazy: nothing is stored."""
    table, build = MODELS[model]
    return build(catalog.table(table))
