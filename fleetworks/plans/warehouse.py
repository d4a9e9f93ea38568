"""The whole warehouse: staging, intermediate results and marts by name, and the daily scoring run.

A model is a function call away from the tables it reads, so asking for one mart builds only what it needs.
Staging and intermediate models stay lazy; marts are stored.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from fleetworks import constants as C
from fleetworks.functions import lookup
from fleetworks.operators import number_rows
from fleetworks.plans import finance, inventory, model, predictive, quality, service, signals, telemetry
from fleetworks.plans.staging import MODELS, stage
from fleetworks.session import settle
from fleetworks.sources import Catalog, write_table


class Warehouse:
    """Marts over the tables of a catalog."""

    def __init__(self, catalog: Catalog):
        self.catalog = catalog

    def stg(self, model_name: str) -> DataFrame:
        return stage(self.catalog, f"stg_{model_name}")

    # intermediate

    @cached_property
    def monthly(self) -> DataFrame:
        lines = finance.revenue_lines(
            self.stg("equipment_sales"), self.stg("rental_contracts"), self.stg("maintenance_events"))
        return settle(finance.monthly_lines(lines), "monthly-lines")

    def revenue_by_stream_month(self) -> DataFrame:
        return finance.revenue_by_stream_month(self.monthly)

    def tax_allocated_to_month(self) -> DataFrame:
        return finance.allocate_period_to_month(self.stg("tax_filings"), finance.revenue_rows(self.monthly))

    def parts_consumption(self) -> DataFrame:
        return inventory.parts_consumption(self.stg("maintenance_parts_used"), self.stg("maintenance_events"))

    # marts

    def finance_monthly(self) -> DataFrame:
        return finance.finance_monthly(
            finance.revenue_rows(self.monthly), self.tax_allocated_to_month(), finance.sales_margin_by_month(self.monthly),
            self.stg("customers"), self.stg("industries"))

    def customer_concentration(self) -> DataFrame:
        return finance.customer_concentration(self.finance_monthly(), self.stg("customers"), self.stg("industries"))

    def branch_performance(self) -> DataFrame:
        return service.branch_performance(self.stg("maintenance_events"), self.stg("technicians"))

    def maintenance_type_ratio(self) -> DataFrame:
        return service.maintenance_type_ratio(self.stg("maintenance_events"))

    def fleet_operations(self) -> DataFrame:
        return service.fleet_operations(
            self.stg("equipment"), self.stg("equipment_models"), self.stg("equipment_categories"), self.stg("customers"),
            self.stg("telemetry_daily"), self.stg("maintenance_events"), self.stg("rental_contracts"))

    def warehouse_inventory(self) -> DataFrame:
        return inventory.warehouse_inventory(
            self.stg("inventory"), self.stg("parts"), self.parts_consumption(), self.stg("parts_demand_forecast"))

    def predictive_maintenance(self) -> DataFrame:
        return signals.predictive_signals_enriched(
            self.stg("ml_signals"), self.stg("equipment"), self.stg("customers"), self.stg("equipment_models"),
            self.stg("equipment_categories"), self.stg("components"), self.stg("maintenance_events"))

    def parts_catalog_gaps(self) -> DataFrame:
        return signals.catalog_gaps(
            self.stg("parts_mapping_gaps"), self.stg("ml_signals"), self.stg("equipment"), self.stg("customers"),
            self.stg("industries"), self.stg("components"), self.stg("equipment_models"), self.stg("equipment_categories"))

    def parts_catalog_gaps_summary(self) -> DataFrame:
        return signals.catalog_gaps_summary(self.parts_catalog_gaps())

    # The marts in the order they can be stored, and the result checks that apply to each.
    MARTS = {
        "finance_monthly": "finance_monthly",
        "customer_concentration": "customer_concentration",
        "branch_performance": "branch_performance",
        "maintenance_type_ratio": None,
        "fleet_operations": "fleet_operations",
        "warehouse_inventory": "warehouse_inventory",
        "predictive_maintenance": "predictive_signals",
        "parts_catalog_gaps": "catalog_gaps",
        "parts_catalog_gaps_summary": None,
    }

    def build(self, name: str) -> DataFrame:
        """Any model by name: ``stg_*`` or a mart."""
        if name in MODELS:
            return stage(self.catalog, name)
        if name not in self.MARTS:
            raise KeyError(f"unknown model: {name}")
        return getattr(self, name)()

    def store(self, out: str, marts: list[str] | None = None) -> dict[str, DataFrame]:
        """Store marts as parquet under ``out`` and return them as read back."""
        stored = {}
        for name in marts or list(self.MARTS):
            write_table(self.build(name), f"{out}/{name}")
            stored[name] = self.catalog.spark.read.parquet(f"{out}/{name}")
        return stored

    def check(self, stored: dict[str, DataFrame]) -> DataFrame:
        """Violations of the data tests over stored marts."""
        return quality.check_results({self.MARTS[n]: df for n, df in stored.items() if self.MARTS.get(n)})


class DailyRun:
    """Score the newest day, then triage, resolve parts and convert, each step feeding the next as a frame."""

    def __init__(self, catalog: Catalog, created_at: datetime, holdout_days: int = C.HOLDOUT_DAYS,
                 sample_days: int | None = None, carry_hours: bool = False):
        self.catalog = catalog
        self.created_at = created_at
        self.holdout_days = holdout_days
        self.sample_days = sample_days
        self.carry_hours = carry_hours

    def table(self, name: str) -> DataFrame:
        return self.catalog.table(name)

    def _recent(self) -> tuple[DataFrame, DataFrame]:
        readings, faults = self.table("fact_telemetry_daily"), self.table("fact_fault_events")
        if self.carry_hours:
            readings = telemetry.carry_engine_hours(readings)
        if self.sample_days:
            newest = readings.agg(F.max("date_id")).scalar()
            cutoff = F.date_sub(newest, self.sample_days)
            readings = readings.filter(F.col("date_id") >= cutoff)
            faults = faults.filter(F.col("event_date") >= cutoff)
        return readings, faults

    @cached_property
    def features(self) -> DataFrame:
        readings, faults = self._recent()
        by_component = predictive.fault_component_daily(faults, self.table("bridge_faultcode_component"))
        failures = predictive.confirmed_failures(self.table("failure_calendar"))
        built = predictive.labelled_features(
            self.table("dim_equipment"), self.table("dim_component"), readings, self.table("fact_maintenance_events"),
            by_component, failures)
        return settle(built, "features")

    def score(self, **training) -> tuple[DataFrame, model.Evaluation]:
        """Signals of the newest day and how the model did on the held-out days."""
        fitted, evaluation = model.train_and_evaluate(self.features, self.holdout_days, **training)
        scored = model.score_latest(self.features, fitted)
        return predictive.signals_table(scored, self.created_at), evaluation

    def triage(self, found: DataFrame) -> DataFrame:
        return settle(signals.apply_triage(
            found, self.table("dim_equipment"), self.table("dim_customer"), self.table("fact_maintenance_events")), "triaged")

    def resolve(self, triaged: DataFrame) -> tuple[DataFrame, DataFrame]:
        catalog = (self.table("dim_equipment"), self.table("bridge_component_part"),
                   self.table("bridge_part_model_compatibility"), self.table("dim_part"))
        return signals.parts_demand(triaged, *catalog), signals.parts_gaps(triaged, *catalog)

    def convert(self, triaged: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Reviewed signals, and all work orders with the new ones appended."""
        reviewed = settle(signals.review_signals(triaged), "reviewed")
        existing = self.table("fact_maintenance_events")
        last = existing.agg(F.coalesce(F.max("work_order_id"), F.lit(0))).scalar()
        created = signals.predictive_work_orders(
            reviewed, self.table("dim_equipment"), self.table("dim_customer"), self.table("dim_technician"),
            C.BRANCH_BY_CUSTOMER, last)
        return reviewed, signals.append_work_orders(existing, created)


def tax_filings(catalog: Catalog, as_of: date) -> DataFrame:
    """Quarterly filings from the catalog's revenue tables, numbered by customer and quarter."""
    lines = finance.revenue_lines(
        catalog.table("fact_equipment_sales"), catalog.table("fact_rental_contracts"),
        catalog.table("fact_maintenance_events"))
    filings = finance.quarterly_tax_filings(finance.monthly_lines(lines), as_of)
    return number_rows(filings, ["customer_id", "period_start"], "filing_id")


def inventory_snapshot(catalog: Catalog, snapshot: date, cover_days: float = 25.0, safety: float = 1.5) -> DataFrame:
    """Stock and reorder points from the catalog's parts consumption."""
    orders = catalog.table("fact_maintenance_events")
    consumption = inventory.parts_consumption(catalog.table("fact_maintenance_parts_used"), orders)
    placed = consumption.withColumn("branch", lookup(C.BRANCH_BY_CUSTOMER, F.col("customer_id").cast("int")))
    parts = catalog.table("dim_part").withColumnRenamed("unit_cost", "unit_cost_usd")
    branches = F.array(*[F.lit(b) for b in C.BRANCHES])
    history = inventory.history_days(orders)
    return inventory.inventory_replenishment(parts, placed, history, branches, snapshot, cover_days, safety)
