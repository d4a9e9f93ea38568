"""What happens to a signal: triage, parts, work orders, catalogue gaps and outcomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from fleetworks import constants as C
from fleetworks.functions import coin, draw, lookup, month_start
from fleetworks.operators import best_per_group, cluster_by_gap, exists_within, frequency, next_at_or_after, number_rows

ACTION = "Action Recommended"


def with_customer(signals: DataFrame, equipment: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the machine's owner, contract tier and model to each signal; NULL where unknown."""
    owners = equipment.select("equipment_id", "customer_id", "model_id").join(
        customers.select("customer_id", "contract_tier"), "customer_id", "left")
    return signals.join(owners, "equipment_id", "left")


def apply_triage(signals: DataFrame, equipment: DataFrame, customers: DataFrame, work_orders: DataFrame) -> DataFrame:
    """Dismiss signals a booked visit already covers, then escalate urgent ones of top-tier customers.

    The order matters: a dismissed signal is no longer on Watch, so it is never escalated. Orders are matched
    by machine, since an order does not say which component it is for.
    """
    open_orders = work_orders.filter(F.col("status") == "Scheduled")
    flagged = exists_within(signals, open_orders, ["equipment_id"], "scoring_date", "scheduled_date",
                            F.col("recommended_action_window_days"), "_covered")
    covered = F.col("_covered") & (F.col("signal_status") != "New")
    after_first = F.when(covered, "Dismissed").otherwise(F.col("signal_status"))
    urgent = (
        (F.col("_status") == "Watch") & (F.col("contract_tier") == C.ESCALATION_TIER)
        & (F.col("recommended_action_window_days") <= C.ESCALATION_WINDOW_DAYS)
    )
    triaged = (
        with_customer(flagged, equipment, customers)
        .withColumn("_status", after_first)
        .withColumn("dismiss_reason", F.when(covered, C.DUPLICATE_REASON).otherwise(F.col("dismiss_reason")))
        .withColumn("signal_status", F.when(urgent, ACTION).otherwise(F.col("_status")))
    )
    return triaged.select(*signals.columns)


def status_frequency(signals: DataFrame) -> DataFrame:
    return frequency(signals, "signal_status")


def _candidates(signals: DataFrame, equipment: DataFrame, component_parts: DataFrame, compatibility: DataFrame,
                parts: DataFrame) -> DataFrame:
    """Recommended signals × candidate part categories, with the first compatible part where there is one."""
    first_part = (
        compatibility.join(parts.select("part_id", "part_category"), "part_id")
        .groupBy("model_id", "part_category").agg(F.min("part_id").alias("part_id"))
    )
    wanted = (
        signals.filter(F.col("signal_status") == ACTION)
        .join(equipment.select("equipment_id", "model_id"), "equipment_id", "left")
        .join(component_parts.withColumnRenamed("component_id", "predicted_component_id"),
              "predicted_component_id", "left")
    )
    return wanted.join(first_part, ["model_id", "part_category"], "left")


def parts_demand(signals: DataFrame, equipment: DataFrame, component_parts: DataFrame, compatibility: DataFrame,
                 parts: DataFrame) -> DataFrame:
    """A forecast row for each part category a recommended signal can be served from, its primary part first."""
    resolved = _candidates(signals, equipment, component_parts, compatibility, parts).filter(F.col("part_id").isNotNull())
    numbered = number_rows(resolved, ["signal_id", ("is_primary", "desc"), "part_category"], "forecast_id")
    return numbered.select(
        "forecast_id", "signal_id", "equipment_id", "part_id", F.col("typical_qty").alias("expected_qty"), "is_primary",
        F.date_add("scoring_date", F.col("recommended_action_window_days")).alias("needed_by_date"),
        F.lit(C.PREDICTIVE_DEMAND).alias("demand_source"))


def parts_gaps(signals: DataFrame, equipment: DataFrame, component_parts: DataFrame, compatibility: DataFrame,
               parts: DataFrame) -> DataFrame:
    """Component and model pairs the catalogue could not serve, each with the earliest signal that met it.

    A component without any category leaves a gap just as a category without a compatible part does.
    """
    missing = _candidates(signals, equipment, component_parts, compatibility, parts).filter(F.col("part_id").isNull())
    pairs = missing.groupBy(F.col("predicted_component_id").alias("component_id"), "model_id").agg(
        F.min("signal_id").alias("signal_id"))
    numbered = number_rows(pairs, ["signal_id", "component_id", "model_id"], "gap_id")
    return numbered.select("gap_id", "signal_id", "component_id", "model_id", F.lit(False).alias("resolved"))


def _technician_slots(technicians: DataFrame) -> DataFrame:
    """Technicians numbered from 0 within their branch, and once more across all branches (pool NULL → '*').

    The numbering is global, so no branch has to be gathered in one task.
    """
    numbered = number_rows(technicians.select("technician_id", "branch"), ["branch", "technician_id"], "_rn", start=0)
    first = numbered.groupBy("branch").agg(F.min("_rn").alias("_first"), F.count("*").alias("_size"))
    everyone = numbered.agg(F.count("*")).scalar()
    by_branch = numbered.join(first, "branch").select(
        F.col("branch").alias("pool"), (F.col("_rn") - F.col("_first")).alias("slot"), "technician_id", "_size")
    overall = numbered.select(F.lit("*").alias("pool"), F.col("_rn").alias("slot"), "technician_id",
                              everyone.alias("_size"))
    return by_branch.unionByName(overall)


def review_signals(signals: DataFrame, dismiss_rate: float = C.ADVISOR_DISMISS_RATE) -> DataFrame:
    """The advisor's decision on each recommended signal: dismissed for a reason, or converted.

    The share dismissed and the reasons are drawn from the signal id, so a rerun decides the same.
    """
    recommended = F.col("signal_status") == ACTION
    dismissed = recommended & coin(F.col("signal_id"), 0, dismiss_rate)
    reasons = F.array(*[F.lit(r) for r in C.ADVISOR_REASONS])
    reason = F.get(reasons, draw(F.col("signal_id"), 1, len(C.ADVISOR_REASONS)).cast("int"))
    return (
        signals.withColumn("_reason", F.when(dismissed, reason))
        .withColumn("_decided", F.when(dismissed, "Dismissed").when(recommended, "Converted"))
        .withColumn("dismiss_reason", F.coalesce("_reason", "dismiss_reason"))
        .withColumn("signal_status", F.coalesce("_decided", "signal_status"))
        .select(*signals.columns)
    )


def predictive_work_orders(reviewed: DataFrame, equipment: DataFrame, customers: DataFrame, technicians: DataFrame,
                           branches: DataFrame | Mapping, last_order_id: Column) -> DataFrame:
    """A scheduled work order for each converted signal, numbered on from the last existing order.

    ``branches`` maps customers to their branch, as a frame or a literal map. An unmapped customer is served
    from the default branch, and a branch without technicians from all of them.
    """
    converted = with_customer(reviewed.filter(F.col("signal_status") == "Converted"), equipment, customers)
    if isinstance(branches, Mapping):
        placed = converted.withColumn("branch", lookup(branches, F.col("customer_id").cast("int")))
    else:
        placed = converted.join(branches.select("customer_id", "branch"), "customer_id", "left")
    placed = placed.withColumn("branch", F.coalesce("branch", F.lit(C.DEFAULT_BRANCH)))
    slots = _technician_slots(technicians)
    pools = slots.filter(F.col("slot") == 0).select("pool", "_size")
    anyone = slots.filter(F.col("pool") == "*").agg(F.max("_size")).scalar()
    pooled = placed.join(pools, F.col("branch") == F.col("pool"), "left").withColumn(
        "pool", F.coalesce("pool", F.lit("*"))).withColumn(
        "slot", draw(F.col("signal_id"), 2, F.coalesce("_size", anyone))).drop("_size")
    assigned = pooled.join(slots.drop("_size"), ["pool", "slot"], "left")

    tier = F.coalesce("contract_tier", F.lit(C.DEFAULT_TIER))
    latest = F.greatest(F.lit(1), F.col("recommended_action_window_days") - 2)
    spread = F.when(tier == C.ESCALATION_TIER, F.greatest(F.lit(1), F.floor(latest / 2).cast("int"))).otherwise(latest)
    offset = F.lit(1) + draw(F.col("signal_id"), 3, spread).cast("int")
    numbered = number_rows(assigned, ["signal_id"], "_n")
    return numbered.select(
        (last_order_id.cast("bigint") + F.col("_n")).alias("work_order_id"), "equipment_id", "customer_id",
        "technician_id", F.lit("Predictive").alias("maintenance_type"),
        F.when(F.col("failure_probability") >= C.CRITICAL_PROBABILITY, "Critical").otherwise("High").alias("priority"),
        F.col("signal_id").alias("source_signal_id"), F.date_add("scoring_date", offset).alias("scheduled_date"),
        lookup(C.SLA_HOURS_BY_TIER, tier, C.DEFAULT_SLA_HOURS).cast("decimal(6,1)").alias("sla_target_hours"),
        F.lit(False).alias("warranty_flag"), F.lit("Scheduled").alias("status"),
        F.lit(False).alias("follow_up_required"))


def append_work_orders(existing: DataFrame, created: DataFrame) -> DataFrame:
    """Existing orders plus new ones; columns a new order does not have yet are NULL."""
    return existing.unionByName(created, allowMissingColumns=True)


def predictive_signals_enriched(signals: DataFrame, equipment: DataFrame, customers: DataFrame, models: DataFrame,
                                categories: DataFrame, components: DataFrame, work_orders: DataFrame) -> DataFrame:
    """Each signal with its machine, owner, component and the work order it led to."""
    machine = (
        equipment.select("equipment_id", "serial_number", "customer_id", "model_id")
        .join(customers.select("customer_id", "customer_name", "contract_tier"), "customer_id", "left")
        .join(models.join(categories, "category_id", "left").select("model_id", "model_name", "category_name"),
              "model_id", "left")
    )
    part = components.select(F.col("component_id").alias("predicted_component_id"), "component_name", "system_category")
    booked = work_orders.filter(F.col("source_signal_id").isNotNull()).select(
        F.col("source_signal_id").alias("signal_id"), F.col("work_order_id").alias("resulting_work_order_id"),
        F.col("scheduled_date").alias("resulting_scheduled_date"))
    return (
        signals.join(machine, "equipment_id", "left").join(part, "predicted_component_id", "left")
        .join(booked, "signal_id", "left")
        .select("signal_id", "equipment_id", "serial_number", "customer_id", "customer_name", "contract_tier",
                "model_name", "category_name", "scoring_date", "predicted_component_id", "component_name",
                "system_category", "failure_probability", "model_version", "recommended_action_window_days",
                "signal_status", "dismiss_reason", "resulting_work_order_id", "resulting_scheduled_date")
    )


def top_risk(enriched: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` most likely failures, most likely first."""
    return enriched.orderBy(F.desc("failure_probability"), "signal_id").limit(k)


def catalog_gaps(gaps: DataFrame, signals: DataFrame, equipment: DataFrame, customers: DataFrame,
                 industries: DataFrame, components: DataFrame, models: DataFrame, categories: DataFrame) -> DataFrame:
    """Each gap with the signal, machine, owner, component and model behind it."""
    owner = (
        equipment.select("equipment_id", "serial_number", "customer_id")
        .join(customers.select("customer_id", "customer_name", "industry_id"), "customer_id", "left")
        .join(industries, "industry_id", "left").drop("industry_id")
    )
    kinds = models.join(categories, "category_id", "left").select("model_id", "model_name", "category_name")
    return (
        gaps.join(signals.select("signal_id", "scoring_date", "equipment_id"), "signal_id", "left")
        .join(owner, "equipment_id", "left").join(components, "component_id", "left").join(kinds, "model_id", "left")
        .select("gap_id", "signal_id", "scoring_date", "equipment_id", "serial_number", "customer_id", "customer_name",
                "industry_name", "component_id", "component_name", "system_category", "model_id", "model_name",
                "category_name", "resolved")
    )


def catalog_gaps_summary(gaps: DataFrame) -> DataFrame:
    """Gaps per model and component: how many, how many open, first and last seen; worst first."""
    keys = ["model_id", "model_name", "category_name", "component_id", "component_name", "system_category"]
    return gaps.groupBy(*keys).agg(
        F.count("*").alias("total_gaps"), F.count_if(~F.col("resolved")).alias("unresolved_gaps"),
        F.min("scoring_date").alias("first_seen"), F.max("scoring_date").alias("last_seen"),
    ).orderBy(F.desc("total_gaps"), "model_id", "component_id")


def signal_outcomes(signals: DataFrame, failures: DataFrame, work_orders: DataFrame, observed_until: Column) -> DataFrame:
    """Whether the predicted component failed inside the window, how early the signal was, and its order.

    A failure counts from the day after the signal on, as it does in the training label. A signal that nothing has
    confirmed while its window reaches beyond ``observed_until`` is undecided: its outcome is NULL.
    """
    window = F.col("recommended_action_window_days")
    renamed = failures.withColumnRenamed("component_id", "predicted_component_id")
    followed = next_at_or_after(
        signals.withColumn("_from", F.date_add("scoring_date", 1)), renamed, ["equipment_id", "predicted_component_id"],
        "_from", "failure_date", "_failure")
    lead = F.datediff("_failure", "scoring_date")
    confirmed = lead <= window
    ended = F.date_add("scoring_date", window) <= observed_until
    orders = best_per_group(
        work_orders.filter(F.col("source_signal_id").isNotNull()).withColumnRenamed("source_signal_id", "signal_id"),
        ["signal_id"], F.col("work_order_id"), ["work_order_id"])
    return followed.join(orders, "signal_id", "left").select(
        "signal_id",
        F.when(confirmed, "Confirmed Failure").when(ended, "False Positive").alias("actual_outcome"),
        F.when(confirmed, lead).alias("lead_time_delivered_days"),
        F.col("work_order_id").alias("resulting_work_order_id"))


def outcome_precision(outcomes: DataFrame) -> DataFrame:
    """Share of the decided signals that a failure confirmed, and their average notice."""
    hit = F.col("actual_outcome") == "Confirmed Failure"
    return outcomes.agg(
        F.count("*").alias("signals"), F.count("actual_outcome").alias("decided"), F.count_if(hit).alias("confirmed"),
        F.avg(F.when(hit, 1.0).when(F.col("actual_outcome").isNotNull(), 0.0)).alias("precision"),
        F.avg("lead_time_delivered_days").alias("avg_lead_time_days"))


def merge_into_visits(signals: DataFrame, max_gap_days: int = 3) -> DataFrame:
    """Group a machine's recommended signals due within a few days of each other into one visit."""
    due = signals.filter(F.col("signal_status") == ACTION).withColumn(
        "due_date", F.date_add("scoring_date", F.col("recommended_action_window_days")))
    return cluster_by_gap(due, ["equipment_id"], "due_date", max_gap_days, "visit_no").select(
        "signal_id", "equipment_id", "due_date", "visit_no")


def expire_signals(signals: DataFrame, as_of: Column) -> DataFrame:
    """Mark signals nobody acted on as Expired once their window has passed."""
    waiting = F.col("signal_status").isin("New", "Watch", ACTION)
    passed = F.date_add("scoring_date", F.col("recommended_action_window_days")) < as_of
    return signals.withColumn("signal_status", F.when(waiting & passed, "Expired").otherwise(F.col("signal_status")))


def signal_funnel(enriched: DataFrame) -> DataFrame:
    """Signals per month and system: all, watched or better, recommended, and booked."""
    watched = F.col("signal_status").isin("Watch", ACTION, "Converted")
    return enriched.groupBy(month_start(F.col("scoring_date")).alias("period_month"), "system_category").agg(
        F.count("*").alias("signals"), F.count_if(watched).alias("watched"),
        F.count_if(F.col("signal_status").isin(ACTION, "Converted")).alias("recommended"),
        F.count("resulting_work_order_id").alias("booked"))


def fault_code_index(signals: DataFrame) -> DataFrame:
    """One row (fault_code, signal_id, position) per code behind a signal: which signals a code stands behind."""
    return signals.select(F.posexplode("contributing_fault_codes").alias("position", "fault_code"), "signal_id").select(
        "fault_code", "signal_id", "position")
