"""Fault features, failure labels and scored signals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks import constants as C
from fleetworks.functions import day_number, logistic, lookup
from fleetworks.operators import (
    carry_forward,
    each_of,
    flag_upcoming,
    number_rows,
    rolling_days,
    scalar_array,
)

SCORE = "decimal(24,4)"
GRID = ["equipment_id", "component_id"]


def fault_component_daily(faults: DataFrame, bridge: DataFrame) -> DataFrame:
    """Weighted fault score per machine, component and day.

    A fault does not say which component it came from, so it counts for every component its code can
    point to, by correlation and severity. Faults with an unmapped code drop out.
    """
    weight = lookup(C.SEVERITY_WEIGHT, F.col("severity"), cast="decimal(3,1)")
    return (
        faults.join(bridge.select("fault_code", "component_id", "correlation_weight"), "fault_code")
        .groupBy("equipment_id", "component_id", F.col("event_date").alias("date_id"))
        .agg(F.sum(F.col("correlation_weight").cast("decimal(6,3)") * weight).cast(SCORE).alias("daily_weighted_score"),
             F.count_if(F.col("severity") == "Critical").alias("daily_critical_count"),
             F.count("*").alias("daily_fault_count"))
    )


#: Grid rows that one task expands, sorts and keeps in its windows.
ROWS_A_TASK = 400_000


def grid_partitions(equipment: DataFrame, components: DataFrame, telemetry: DataFrame, rows_a_task: int = ROWS_A_TASK) -> int:
    """Partitions for the machine × component × day grid: as many as a shuffle has, or more for a grid that needs them."""
    days = telemetry.select("date_id").distinct().count()
    rows = equipment.count() * components.count() * days
    return max(int(equipment.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_task))


def _by_machine(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows placed by machine in a stated number of partitions.

    Without a number, adaptive execution would size the partitions by the rows that move, which are few, and not by the
    grid that is expanded behind them.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(least if partitions is None else partitions, "equipment_id")


def machine_days(equipment: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Every working machine on every telemetry date from its installation on.

    The dates are a calendar, so they travel as an array and each machine expands in place.
    """
    dates = scalar_array(telemetry, "date_id")
    working = equipment.filter(F.col("status").isin("Active", "Idle")).select(
        "equipment_id", "model_id", "customer_id", "install_date")
    return each_of(working, dates, "date_id").filter(F.col("date_id") >= F.col("install_date"))


def dense_spine(equipment: DataFrame, components: DataFrame, telemetry: DataFrame) -> DataFrame:
    """The machine × component × day grid, so that a day without faults is a zero and not a hole.

    Machines are placed before they expand, so that windows per machine find the grid where they need it.
    """
    days = machine_days(_by_machine(equipment), telemetry)
    return each_of(days, scalar_array(components, "component_id"), "component_id")


def maintenance_asof(telemetry: DataFrame, maintenance: DataFrame) -> DataFrame:
    """The last maintenance date known on each machine-day that has telemetry or maintenance.

    Maintenance before the first telemetry day carries into it.
    """
    marks = maintenance.select("equipment_id", F.col("scheduled_date").alias("date_id"))
    days = telemetry.select("equipment_id", "date_id").unionByName(marks).distinct()
    return carry_forward(days, marks, ["equipment_id"], "date_id", "date_id", "last_maint_date", unique=True)


def machine_day_context(equipment: DataFrame, telemetry: DataFrame, maintenance: DataFrame,
                        partitions: int | None = None) -> DataFrame:
    """Machine-days with age, engine hours, use and days since maintenance, at machine-day grain.

    Grid rows, telemetry rows and maintenance marks meet in one window per machine. The result stays
    partitioned by machine, which is what the feature windows need next.
    """
    grid = machine_days(_by_machine(equipment, partitions), telemetry).withColumn("_kind", F.lit(0))
    readings = telemetry.select("equipment_id", "date_id", "engine_hours", "utilization_hours").withColumn(
        "_kind", F.lit(1)).transform(_by_machine, partitions)
    marks = (
        maintenance.select("equipment_id", F.col("scheduled_date").alias("date_id")).distinct()
        .withColumn("_mark", F.col("date_id")).withColumn("_kind", F.lit(2)).transform(_by_machine, partitions)
    )
    rows = grid.unionByName(readings, allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy("equipment_id").orderBy("_day")
    today = order.rangeBetween(0, 0)
    so_far = order.rangeBetween(Window.unboundedPreceding, 0)
    # the last maintenance date is only known on days with a reading or a mark of their own
    known = F.max(F.when(F.col("_kind") > 0, 1)).over(today)
    since = F.datediff("date_id", F.max("_mark").over(so_far))
    return (
        rows.withColumn("_day", day_number(F.col("date_id")))
        .withColumn("hours", F.max("engine_hours").over(today))
        .withColumn("used", F.max("utilization_hours").over(today))
        .withColumn("days_since_last_maintenance",
                    F.coalesce(F.when(known == 1, since), F.lit(C.NEVER_MAINTAINED_DAYS)))
        .filter(F.col("_kind") == 0)
        .select("equipment_id", "model_id", "customer_id", "date_id",
                F.datediff("date_id", "install_date").alias("machine_age_days"),
                F.col("hours").alias("engine_hours"), F.col("used").alias("utilization_hours"),
                "days_since_last_maintenance")
    )


def labelled_features(equipment: DataFrame, components: DataFrame, telemetry: DataFrame, maintenance: DataFrame,
                      component_faults: DataFrame, failures: DataFrame | None = None,
                      label_days: int = C.LABEL_WINDOW_DAYS, partitions: int | None = None) -> DataFrame:
    """Rolling 7/14/30-day features, and with ``failures`` the label, for the whole grid.

    Grid, fault days and failure days are unioned, each partitioned by machine, and every rolling sum
    and the look-ahead label come out of windows over that one placement: the grid, by far the largest
    frame, is expanded after the shuffle and never moves; the partitions grow with it. Faults on a day outside the
    grid do not count.
    """
    partitions = partitions or grid_partitions(equipment, components, telemetry)
    context = machine_day_context(equipment, telemetry, maintenance, partitions)
    grid = each_of(context, scalar_array(components, "component_id"), "component_id").withColumn("_grid", F.lit(1))
    faults = component_faults.withColumn("_grid", F.lit(0)).transform(_by_machine, partitions)
    rows = grid.unionByName(faults, allowMissingColumns=True)
    if failures is not None:
        failed = (
            failures.select("equipment_id", "component_id", F.col("failure_date").alias("date_id")).distinct()
            .withColumn("_failed", F.lit(1)).withColumn("_grid", F.lit(0)).transform(_by_machine, partitions)
        )
        rows = rows.unionByName(failed, allowMissingColumns=True)
    rows = rows.withColumn("_day", day_number(F.col("date_id")))

    rows = rows.withColumn("_in", rolling_days("_grid", GRID, "_day", 1))
    in_grid = F.col("_in") > 0
    zero = F.lit(0)
    # scores as whole ten-thousandths: window sums over longs are exact and far cheaper than over wide decimals
    score = F.when(in_grid, F.coalesce(F.col("daily_weighted_score") * 10000, zero)).otherwise(zero).cast("bigint")
    critical = F.when(in_grid, F.coalesce("daily_critical_count", zero)).otherwise(zero)
    count = F.when(in_grid, F.coalesce("daily_fault_count", zero)).otherwise(zero)
    rows = rows.withColumn("_score", score).withColumn("_critical", critical).withColumn("_count", count)

    def as_score(units: Column) -> Column:
        return (units.cast("decimal(19,0)") / F.lit(10000).cast("decimal(5,0)")).cast(SCORE)

    features = {
        "daily_weighted_score": rolling_days("_score", GRID, "_day", 1),
        "daily_critical_count": rolling_days("_critical", GRID, "_day", 1),
        "daily_fault_count": rolling_days("_count", GRID, "_day", 1),
        "weighted_score_7d": rolling_days("_score", GRID, "_day", 7),
        "weighted_score_14d": rolling_days("_score", GRID, "_day", 14),
        "weighted_score_30d": rolling_days("_score", GRID, "_day", 30),
        "critical_count_7d": rolling_days("_critical", GRID, "_day", 7),
        "critical_count_14d": rolling_days("_critical", GRID, "_day", 14),
    }
    if failures is not None:
        features["label"] = flag_upcoming("_failed", GRID, "_day", label_days)
    windowed = rows.select(
        "equipment_id", "component_id", "date_id", "model_id", "customer_id", "_grid",
        *[F.coalesce(expr, zero).alias(name) for name, expr in features.items()],
        "machine_age_days", "engine_hours", "utilization_hours", "days_since_last_maintenance")
    scores = {name: as_score(F.col(name)) for name in features if "score" in name}
    return windowed.filter(F.col("_grid") == 1).drop("_grid").withColumns(scores)


def rolling_features(equipment: DataFrame, components: DataFrame, telemetry: DataFrame, maintenance: DataFrame,
                     component_faults: DataFrame) -> DataFrame:
    return labelled_features(equipment, components, telemetry, maintenance, component_faults)


def confirmed_failures(calendar: DataFrame) -> DataFrame:
    """The failures of an event calendar, which also holds false starts."""
    return calendar.filter(F.col("event_type") == C.FAILURE).select(*GRID, "failure_date")


def failure_labels(spine: DataFrame, failures: DataFrame, label_days: int = C.LABEL_WINDOW_DAYS) -> DataFrame:
    """Label grid rows 1 when the same component of the same machine fails in the next ``label_days`` days.

    A failure on the row's own day does not count; one exactly ``label_days`` ahead does.
    """
    failed = (
        failures.select(*GRID, F.col("failure_date").alias("date_id")).distinct().withColumn("_failed", F.lit(1))
        .transform(_by_machine)
    )
    rows = spine.withColumn("_failed", F.lit(None).cast("int")).unionByName(failed, allowMissingColumns=True)
    tagged = rows.withColumn("_day", day_number(F.col("date_id")))
    return (
        tagged.withColumn("label", flag_upcoming("_failed", GRID, "_day", label_days))
        .filter(F.col("_failed").isNull()).drop("_failed", "_day")
    )


def recent_days(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows from ``days`` before the newest date on."""
    newest = df.agg(F.max(day)).scalar()
    return df.filter(F.col(day) >= F.date_sub(newest, days))


def holdout_split(features: DataFrame, holdout_days: int = C.HOLDOUT_DAYS, purge_days: int = 0) -> DataFrame:
    """Tag each row ``train`` or ``test`` by date, the newest ``holdout_days`` being the test set.

    ``purge_days`` drops the training rows just before the cutoff, whose labels look into the test period.
    """
    newest = features.agg(F.max("date_id")).scalar()
    cutoff = F.date_sub(newest, holdout_days)
    split = F.when(F.col("date_id") >= cutoff, "test").when(F.col("date_id") < F.date_sub(cutoff, purge_days), "train")
    return features.withColumn("split", split).filter(F.col("split").isNotNull())


def label_rates(tagged: DataFrame) -> DataFrame:
    """Rows, positives and positive rate per split."""
    return tagged.groupBy("split").agg(
        F.count("*").alias("row_count"), F.sum("label").cast("bigint").alias("positives"),
        F.avg("label").alias("positive_rate"))


def latest_scores(equipment: DataFrame, components: DataFrame, telemetry: DataFrame,
                  component_faults: DataFrame) -> DataFrame:
    """Rolling scores of the newest telemetry day only, straight from the sparse fault days.

    Equal to the newest day of ``rolling_features`` without building the grid: each fault day adds to the
    windows it falls in, and machines and components expand to one row per pair.
    """
    dates = scalar_array(telemetry, "date_id")
    newest = F.array_max(dates)
    working = equipment.filter(F.col("status").isin("Active", "Idle") & (F.col("install_date") <= newest)).select(
        "equipment_id", "install_date")
    age = F.datediff(newest, F.col("date_id"))
    seen = (
        component_faults.filter(F.col("date_id").between(F.date_sub(newest, 29), newest))
        .filter(F.array_contains(dates, F.col("date_id")))
        .join(working, "equipment_id").filter(F.col("date_id") >= F.col("install_date"))
        .groupBy(*GRID).agg(
            F.sum(F.when(age < 7, F.col("daily_weighted_score"))).alias("weighted_score_7d"),
            F.sum(F.when(age < 14, F.col("daily_weighted_score"))).alias("weighted_score_14d"),
            F.sum("daily_weighted_score").alias("weighted_score_30d"),
            F.sum(F.when(age < 7, F.col("daily_critical_count"))).alias("critical_count_7d"),
        )
    )
    pairs = each_of(working.select("equipment_id"), scalar_array(components, "component_id"), "component_id")
    scores = ["weighted_score_7d", "weighted_score_14d", "weighted_score_30d"]
    return pairs.join(seen, GRID, "left").select(
        *GRID, newest.alias("scoring_date"),
        *[F.coalesce(c, F.lit(0)).cast(SCORE).alias(c) for c in scores],
        F.coalesce("critical_count_7d", F.lit(0)).cast("bigint").alias("critical_count_7d"))


def risk_score(score: str | Column, low: float = 0.02, high: float = 0.98, midpoint: float = 12.0,
               steepness: float = 0.25) -> Column:
    """A fixed S-curve from a rolling fault score to a probability, usable without a trained model."""
    return logistic(F.col(score).cast("double") if isinstance(score, str) else score.cast("double"), low, high, midpoint, steepness)


def triage_status(probability: Column) -> Column:
    return (
        F.when(probability >= C.ACTION_THRESHOLD, "Action Recommended")
        .when(probability >= C.WATCH_THRESHOLD, "Watch").otherwise("New")
    )


def signals_table(scored: DataFrame, created_at: datetime | None = None, model_version: str = C.MODEL_VERSION,
                  fault_codes: DataFrame | None = None) -> DataFrame:
    """Scored pairs as signal rows in their stored column order, numbered by machine and component.

    ``scored`` has equipment_id, component_id, scoring_date and failure_probability. ``fault_codes`` may
    add the codes behind each signal; without it the column is NULL.
    """
    stamp = F.lit(created_at) if created_at else F.current_timestamp()
    rows = scored.select(
        "equipment_id", "scoring_date", F.col("component_id").alias("predicted_component_id"),
        "failure_probability", F.lit(model_version).alias("model_version"),
        lookup(C.ACTION_WINDOW_BY_COMPONENT, F.col("component_id").cast("int")).alias("recommended_action_window_days"),
        triage_status(F.col("failure_probability")).alias("signal_status"),
        F.lit(None).cast("string").alias("dismiss_reason"), stamp.alias("created_at"))
    if fault_codes is None:
        rows = rows.withColumn("contributing_fault_codes", F.lit(None).cast("array<string>"))
    else:
        keyed = fault_codes.withColumnRenamed("component_id", "predicted_component_id")
        rows = rows.join(keyed, ["equipment_id", "predicted_component_id"], "left")
    numbered = number_rows(rows, ["equipment_id", "predicted_component_id"], "signal_id")
    return numbered.select(
        "signal_id", "equipment_id", "scoring_date", "predicted_component_id", "failure_probability",
        "model_version", "recommended_action_window_days", "contributing_fault_codes", "signal_status",
        "dismiss_reason", "created_at")


def contributing_fault_codes(faults: DataFrame, bridge: DataFrame, newest: Column, days: int = 14) -> DataFrame:
    """Distinct codes seen per machine and component in the trailing ``days`` days.

    Codes come from a fixed dictionary and are made distinct before they are gathered.
    """
    return (
        faults.filter(F.col("event_date").between(F.date_sub(newest, days - 1), newest))
        .select("equipment_id", "fault_code").distinct()
        .join(bridge.select("fault_code", "component_id"), "fault_code")
        .groupBy(*GRID).agg(F.array_sort(F.collect_set("fault_code")).alias("contributing_fault_codes"))
    )


def fault_trend(component_faults: DataFrame, components: DataFrame) -> DataFrame:
    """Faults per day and system."""
    return (
        component_faults.join(components.select("component_id", "system_category"), "component_id")
        .groupBy("date_id", "system_category")
        .agg(F.sum("daily_fault_count").alias("faults"), F.sum("daily_critical_count").alias("criticals"),
             F.sum("daily_weighted_score").cast(SCORE).alias("weighted_score"))
    )
