"""Work orders: branch performance, type mix, costing, and fleet reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetworks import constants as C
from fleetworks.functions import hours_between, month_start
from fleetworks.operators import gap_since_previous


def _mean(value: str, where: Column | None = None) -> Column:
    """Average of a decimal column kept exact enough to round afterwards; NULL where nothing matches."""
    picked = F.when(where, F.col(value)) if where is not None else F.col(value)
    return F.sum(picked).cast("decimal(20,3)") / F.nullif(F.count(picked), F.lit(0)).cast("decimal(14,0)")


def branch_performance(work_orders: DataFrame, technicians: DataFrame, approximate: bool = False) -> DataFrame:
    """Completed orders per technician's branch and month: mix, downtime and service-level compliance.

    An order without start or completion is not measurable and counts neither way. Orders whose
    technician is unknown form a group with a NULL branch. ``approximate`` estimates the number of distinct
    technicians instead of counting them.
    """
    done = work_orders.filter(F.col("status") == "Completed").join(
        technicians.select("technician_id", "branch"), "technician_id", "left")
    duration = hours_between(F.col("actual_start"), F.col("actual_completion"))
    measurable = duration.isNotNull()
    met = measurable & (duration <= F.col("sla_target_hours").cast("double"))

    active = F.approx_count_distinct("technician_id") if approximate else F.countDistinct("technician_id")

    def of(kind: str) -> Column:
        return F.count_if(F.col("maintenance_type") == kind)

    grouped = done.groupBy("branch", month_start(F.col("scheduled_date")).alias("period_month")).agg(
        F.count("*").alias("work_order_count"),
        of("Preventive").alias("preventive_count"), of("Corrective").alias("corrective_count"),
        of("Predictive").alias("predictive_count"), of("Inspection").alias("inspection_count"),
        F.round(_mean("downtime_hours"), 2).cast("decimal(10,2)").alias("avg_downtime_hours"),
        F.count_if(measurable).alias("sla_measurable_count"), F.count_if(met).alias("sla_met_count"),
        active.alias("active_technicians"),
    )
    met_share = F.col("sla_met_count").cast("decimal(14,0)") * 100 / F.nullif("sla_measurable_count", F.lit(0)).cast(
        "decimal(14,0)")
    return grouped.withColumn("sla_compliance_pct", F.round(met_share, 1).cast("decimal(5,1)"))


def maintenance_type_ratio(work_orders: DataFrame) -> DataFrame:
    """Completed orders per month, type and whether a signal caused them."""
    return (
        work_orders.filter(F.col("status") == "Completed")
        .groupBy(month_start(F.col("scheduled_date")).alias("period_month"), "maintenance_type",
                 "is_predictive_sourced")
        .agg(F.count("*").alias("work_order_count"))
    )


def work_order_costing(work_orders: DataFrame, parts_used: DataFrame, parts: DataFrame,
                       equipment: DataFrame) -> DataFrame:
    """Parts at converted cost plus labour per order, and whether it falls in the warranty period."""
    fx = F.lit(C.USD_TO_GHS).cast("decimal(8,2)")
    line_cost = F.col("qty_used").cast("decimal(10,0)") * F.col("unit_cost_usd").cast("decimal(12,2)") * fx
    parts_cost = (
        parts_used.join(parts.select("part_id", "unit_cost_usd"), "part_id")
        .groupBy("work_order_id").agg(F.sum(line_cost.cast("decimal(24,4)")).cast("decimal(24,4)").alias("parts_cost"))
    )
    labour = F.coalesce(F.col("labor_hours"), F.lit(0)).cast("decimal(8,1)") * F.lit(C.LABOUR_RATE_GHS).cast("decimal(6,0)")
    age = F.datediff("scheduled_date", "install_date")
    return (
        work_orders.join(parts_cost, "work_order_id", "left")
        .join(equipment.select("equipment_id", "install_date"), "equipment_id", "left")
        .select("work_order_id", "equipment_id", "scheduled_date",
                F.round(F.coalesce("parts_cost", F.lit(0)), 2).cast("decimal(20,2)").alias("parts_cost"),
                labour.cast("decimal(14,2)").alias("labour_cost"),
                F.bround(F.coalesce("parts_cost", F.lit(0)) + labour, 2).cast("decimal(20,2)").alias("total_cost"),
                (age <= C.WARRANTY_DAYS).alias("warranty_eligible"))
    )


def corrective_gaps(work_orders: DataFrame) -> DataFrame:
    """Days with completed corrective work per machine, and the days since the previous one."""
    corrective = work_orders.filter((F.col("maintenance_type") == "Corrective") & (F.col("status") == "Completed"))
    return gap_since_previous(corrective, ["equipment_id"], "scheduled_date", "days_since_prior_corrective")


def fleet_operations(equipment: DataFrame, models: DataFrame, categories: DataFrame, customers: DataFrame,
                     telemetry: DataFrame, work_orders: DataFrame, rentals: DataFrame) -> DataFrame:
    """One row per machine: use, faults, repair and failure intervals, and rental totals.

    The mean gap between consecutive corrective orders is the span from first to last over the number of
    steps, so it needs no ordering of the orders, only aggregates that combine before the shuffle.
    """
    use = telemetry.groupBy("equipment_id").agg(
        _mean("utilization_hours").alias("avg_daily_utilization_hours"),
        F.max("engine_hours").alias("latest_engine_hours"),
        F.sum("fault_count_critical").alias("total_critical_faults"),
    )
    corrective = F.col("maintenance_type") == "Corrective"
    corrective_day = F.when(corrective, F.col("scheduled_date"))
    steps = F.nullif(F.count_if(corrective) - 1, F.lit(0)).cast("decimal(14,0)")
    span = F.datediff(F.max(corrective_day), F.min(corrective_day)).cast("decimal(10,0)")
    upkeep = work_orders.filter(F.col("status") == "Completed").groupBy("equipment_id").agg(
        F.count_if(corrective).alias("corrective_count"),
        _mean("downtime_hours", corrective).alias("avg_mttr_hours"),
        F.sum("downtime_hours").alias("total_downtime_hours"),
        F.max("scheduled_date").alias("last_service_date"),
        (span / steps).alias("mtbf_days"),
    )
    rented = rentals.groupBy("equipment_id").agg(
        F.sum("total_billed").alias("total_rental_billed"),
        F.sum("actual_usage_hours").alias("total_actual_usage_hours"),
    )
    kinds = models.join(categories, "category_id", "left").select(
        "model_id", "model_name", "category_name", "primary_application")
    owners = customers.select(F.col("customer_id").alias("dim_customer_id"), "customer_name", "customer_type", "region")
    return (
        equipment.join(use, "equipment_id", "left").join(upkeep, "equipment_id", "left")
        .join(rented, "equipment_id", "left").join(kinds, "model_id", "left")
        .join(owners, F.col("customer_id") == F.col("dim_customer_id"), "left")
        .select("equipment_id", "serial_number", "ownership_type", "status", "install_date", "model_name",
                "category_name", "primary_application", F.col("dim_customer_id").alias("customer_id"),
                "customer_name", "customer_type", "region", "avg_daily_utilization_hours", "latest_engine_hours",
                "total_critical_faults", "corrective_count", "avg_mttr_hours", "total_downtime_hours",
                "last_service_date", "mtbf_days", "total_rental_billed", "total_actual_usage_hours")
    )


def ownership_split(fleet: DataFrame) -> DataFrame:
    """Machines, use and downtime by ownership."""
    return fleet.groupBy("ownership_type").agg(
        F.count("*").alias("machines"),
        F.sum("corrective_count").alias("corrective_orders"),
        F.sum("total_downtime_hours").alias("downtime_hours"),
        F.sum("total_rental_billed").alias("rental_billed"),
        F.sum("total_actual_usage_hours").alias("usage_hours"),
    )


def rental_use(fleet: DataFrame) -> DataFrame:
    """Rented-out machines with what was billed, the hours used, and the amount per hour."""
    hours = F.nullif(F.col("total_actual_usage_hours"), F.lit(0)).cast("decimal(18,1)")
    return fleet.filter(F.col("total_rental_billed").isNotNull()).select(
        "equipment_id", "ownership_type", "total_rental_billed", "total_actual_usage_hours",
        F.round(F.col("total_rental_billed").cast("decimal(18,2)") / hours, 2).cast("decimal(18,2)").alias("billed_per_hour"))


SKETCH_BITS = 12


def machine_sketches(work_orders: DataFrame, branch_of_customer: DataFrame) -> DataFrame:
    """Per branch and month a sketch of the machines served: some kilobytes, however many machines."""
    dated = work_orders.join(branch_of_customer, "customer_id").select(
        "branch", month_start(F.col("scheduled_date")).alias("period_month"), "equipment_id")
    return dated.groupBy("branch", "period_month").agg(F.hll_sketch_agg("equipment_id", SKETCH_BITS).alias("machines"))


def machines_served(sketches: DataFrame, grain: str) -> DataFrame:
    """Estimated distinct machines per branch and ``quarter`` or ``year``, by merging stored months.

    Months can't be added up, since a machine comes back; sketches can. The standard error is 1.04 / sqrt(2 ** SKETCH_BITS).
    """
    period = F.trunc("period_month", grain).alias("period_start")
    return sketches.groupBy("branch", period).agg(F.hll_sketch_estimate(F.hll_union_agg("machines")).alias("machines"))
