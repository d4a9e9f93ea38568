"""Parts consumption, stock position and replenishment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks import constants as C
from fleetworks.functions import safe_ratio
from fleetworks.operators import each_of


def parts_consumption(parts_used: DataFrame, work_orders: DataFrame) -> DataFrame:
    """Parts used with the customer and date of their order."""
    return parts_used.join(work_orders.select("work_order_id", "customer_id", "scheduled_date"), "work_order_id").select(
        "part_id", "customer_id", "scheduled_date", "qty_used")


def warehouse_inventory(inventory: DataFrame, parts: DataFrame, consumption: DataFrame, forecast: DataFrame,
                        integer_division: bool = False) -> DataFrame:
    """Stock per part and branch at cost, with turnover, dead stock and predicted demand.

    Consumption is known per part, not per branch, so all branches of a part share its figures. The rate
    is annualised over the span of all consumption. ``integer_division`` truncates units per day before
    annualising, which makes every slow part 0; some warehouses report it that way.
    """
    per_part = consumption.groupBy("part_id").agg(
        F.sum("qty_used").cast("bigint").alias("total_qty_used"),
        F.max("scheduled_date").alias("last_consumption_date"),
        F.min("scheduled_date").alias("_first"))
    span = per_part.agg(F.datediff(F.max("last_consumption_date"), F.min("_first"))).scalar()
    days = F.nullif(span, F.lit(0))
    if integer_division:
        annual = (F.floor(F.col("total_qty_used") / days) * 365).cast("decimal(20,6)")
    else:
        annual = (F.col("total_qty_used").cast("decimal(18,0)") * 365 / days.cast("decimal(10,0)")).cast("decimal(20,6)")
    used = per_part.select("part_id", "last_consumption_date", annual.alias("annualized"))

    predictive = F.col("demand_source") == C.PREDICTIVE_DEMAND
    demand = forecast.groupBy("part_id").agg(
        F.count_if(predictive).alias("signals"),
        F.sum(F.when(predictive, F.col("expected_qty"))).alias("qty"))

    idle = F.datediff("snapshot_date", "last_consumption_date")
    dead = (F.col("qty_on_hand") > 0) & (F.col("last_consumption_date").isNull() | (idle > C.DEAD_STOCK_DAYS))
    yearly = F.coalesce("annualized", F.lit(0)).cast("decimal(20,6)")
    return (
        inventory.join(parts.select("part_id", "part_number", "part_name", "part_category"), "part_id", "left")
        .join(used, "part_id", "left").join(demand, "part_id", "left")
        .select("part_id", "part_number", "part_name", "part_category", "branch", "snapshot_date", "qty_on_hand",
                "unit_cost_ghs", "inventory_value_ghs", "reorder_point", "days_of_supply", "is_below_reorder_point",
                yearly.alias("annualized_consumption"),
                F.when(F.col("qty_on_hand") > 0, F.round(safe_ratio(yearly, F.col("qty_on_hand").cast("decimal(12,0)")), 2))
                .cast("decimal(18,2)").alias("inventory_turnover_ratio"),
                "last_consumption_date", idle.alias("days_since_last_consumption"),
                dead.alias("is_dead_stock"),
                F.when(dead, F.col("inventory_value_ghs")).otherwise(F.lit(0)).cast("decimal(24,2)")
                .alias("dead_stock_value"),
                F.coalesce("signals", F.lit(0)).alias("predictive_demand_signals"),
                F.coalesce("qty", F.lit(0)).alias("predictive_demand_qty"))
    )


def history_days(work_orders: DataFrame) -> Column:
    """Days from the first to the last work order, at least one, as a scalar subquery."""
    day = "scheduled_date"
    return work_orders.agg(F.greatest(F.lit(1), F.datediff(F.max(day), F.min(day)))).scalar()


def inventory_replenishment(parts: DataFrame, consumption: DataFrame, history: Column, branches: Column, snapshot: date,
                            cover_days: float = 25.0, safety: float = 1.5) -> DataFrame:
    """Stock and reorder point per part and branch from the part's consumption history.

    ``consumption`` has part_id, branch and qty_used; use outside any branch still counts towards the part's total.
    ``history`` is the days it spans and ``branches`` an array of every branch. Stock covers ``cover_days`` of use, the reorder point the lead time with a ``safety`` margin;
    both are split over the branches by their share of use, each branch counted one unit up so that
    none is left without. Days of supply divide a branch's stock by the part's use everywhere.
    """
    per_branch = consumption.groupBy("part_id", "branch").agg(F.sum("qty_used").alias("used"))
    totals = per_branch.groupBy("part_id").agg(F.sum("used").cast("double").alias("_total"))
    used_parts = parts.select("part_id", "unit_cost_usd", "lead_time_days").join(totals, "part_id", "left")
    slots = each_of(used_parts, branches, "branch")
    weight = F.coalesce("used", F.lit(0)).cast("double") + 1.0
    daily = F.coalesce("_total", F.lit(0.0)) / history
    weighted = (
        slots.join(per_branch, ["part_id", "branch"], "left")
        .withColumn("_share", weight / F.sum(weight).over(Window.partitionBy("part_id")))
        .withColumn("avg_daily_use", F.greatest(daily, F.lit(C.MIN_DAILY_USE)))
    )

    def whole(value: Column, at_least: int) -> Column:
        return F.greatest(F.lit(float(at_least)), F.bround(value, 0))

    stock = whole(F.col("avg_daily_use") * cover_days, 1)
    reorder = whole(F.col("avg_daily_use") * F.col("lead_time_days") * F.lit(safety), 1)
    fx = F.lit(C.USD_TO_GHS).cast("decimal(8,2)")
    return weighted.select(
        "part_id", "branch", F.lit(snapshot).alias("snapshot_date"),
        whole(stock * F.col("_share"), 0).cast("int").alias("qty_on_hand"),
        F.bround(F.col("unit_cost_usd").cast("decimal(12,2)") * fx, 2).cast("decimal(14,2)").alias("unit_cost"),
        whole(reorder * F.col("_share"), 1).cast("int").alias("reorder_point"),
        F.bround(whole(stock * F.col("_share"), 0) / F.col("avg_daily_use"), 1).alias("days_of_supply"),
    )


def baseline_demand(consumption: DataFrame, horizon_days: int) -> DataFrame:
    """Expected use per part over the horizon at the average daily rate, rounded up, as forecast rows."""
    per_part = consumption.groupBy("part_id").agg(
        F.sum("qty_used").cast("bigint").alias("total"), F.max("scheduled_date").alias("last"),
        F.min("scheduled_date").alias("first"))
    days = per_part.agg(F.greatest(F.lit(1), F.datediff(F.max("last"), F.min("first")))).scalar()
    expected = F.ceil(F.col("total") * F.lit(horizon_days) / days)
    return per_part.select("part_id", expected.cast("bigint").alias("expected_qty"),
                           F.lit(C.BASELINE_DEMAND).alias("demand_source"))


def parts_at_risk(forecast: DataFrame, inventory: DataFrame) -> DataFrame:
    """Primary parts whose predicted demand exceeds all stock on hand."""
    needed = (
        forecast.filter(F.col("is_primary") & (F.col("demand_source") == C.PREDICTIVE_DEMAND))
        .groupBy("part_id").agg(F.sum("expected_qty").cast("bigint").alias("expected_qty"),
                                F.count("*").alias("waiting_signals"), F.min("needed_by_date").alias("first_needed"))
    )
    stock = inventory.groupBy("part_id").agg(F.sum("qty_on_hand").cast("bigint").alias("qty_on_hand"))
    return needed.join(stock, "part_id", "left").filter(
        F.coalesce("qty_on_hand", F.lit(0)) < F.col("expected_qty")
    ).select("part_id", "expected_qty", "waiting_signals", "first_needed",
             F.coalesce("qty_on_hand", F.lit(0)).alias("qty_on_hand"))
