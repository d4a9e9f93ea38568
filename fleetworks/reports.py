"""Named reports over one data folder: every plan wired to its inputs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetworks.constants import FEATURES
from fleetworks.operators import number_rows, scalar_array
from fleetworks.plans import evaluation, finance, governance, inventory, model, predictive, quality, service, signals, staging, telemetry
from fleetworks.plans.increments import FeatureStore
from fleetworks.schemas import CONSTRAINTS, Constraints
from fleetworks.session import scratch_dir, settle
from fleetworks.sources import Catalog, append_missing, as_messages, conform, csv_scan, literal_frame, write_csv, write_table
from fleetworks.sources.testbed import AS_OF, HOLDOUT_DAYS, REGIONS_BY_ROLE, SNAPSHOT, Testbed
from fleetworks.streaming import FaultLanding, KeyedUpsert, TelemetryLanding, drain, file_source, land_streams
from fleetworks.streaming.rollup import COUNTS, DAILY, LateRollup, daily_fault_rollup

Report = Callable[[SparkSession, str], DataFrame]
REPORTS: dict[str, Report] = {}

CREATED_AT = datetime(2024, 1, 31)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)


def present(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Reporting types: long for whole numbers, double for decimals, rounded where asked."""
    columns = []
    for f in df.schema.fields:
        c: Column = F.col(f.name)
        if isinstance(f.dataType, INTEGRAL):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if digits and f.name in digits:
            c = F.round(c, digits[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


def report(function: Report) -> Report:
    REPORTS[function.__name__] = function
    return function


# Finance


class FinanceInputs:
    """The monthly base and what derives from it.

    The base is written once and placed by customer for what reads it several times, so no later step moves its rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.bed = Testbed(spark, root)

    @cached_property
    def monthly(self) -> DataFrame:
        return finance.by_customer(settle(finance.monthly_lines(self.bed.revenue_lines()), "monthly-lines"))

    def revenue(self) -> DataFrame:
        return finance.revenue_rows(self.monthly)

    def filings(self) -> DataFrame:
        return finance.quarterly_tax_filings(self.monthly, AS_OF)

    def filings_alone(self) -> DataFrame:
        """The filings for a query that reads the base for nothing else, where writing and placing it first is lost."""
        return finance.quarterly_tax_filings(finance.monthly_lines(self.bed.revenue_lines()), AS_OF)

    def allocated(self) -> DataFrame:
        return finance.allocate_period_to_month(self.filings(), self.revenue())

    def monthly_finance(self) -> DataFrame:
        return finance.finance_monthly(
            self.revenue(), self.allocated(), finance.sales_margin_by_month(self.monthly), self.bed.customers(),
            self.bed.industries())

    def concentration(self, monthly_finance: DataFrame | None = None) -> DataFrame:
        source = self.monthly_finance() if monthly_finance is None else monthly_finance
        return finance.customer_concentration(source, self.bed.customers(), self.bed.industries())


@report
def revenue_by_stream_month(spark, root):
    lines = Testbed(spark, root).revenue_lines()
    return present(finance.revenue_by_stream_month(finance.monthly_lines(lines)))


def _stored(fmt: str, **tables: DataFrame) -> Catalog:
    """A warehouse folder holding these frames as the tables they are named after."""
    spark = next(iter(tables.values())).sparkSession
    catalog = Catalog(spark, scratch_dir(spark, "warehouse"), fmt)
    for name, df in tables.items():
        (write_csv if fmt == "csv" else write_table)(conform(df, name), catalog.path(name))
    return catalog


@report
def staged_sales(spark, root):
    """Sales from a CSV folder of several part files, with their margin."""
    catalog = _stored("csv", fact_equipment_sales=Testbed(spark, root).equipment_sales())
    return present(staging.stage(catalog, "stg_equipment_sales"))


@report
def staged_rentals(spark, root):
    """Contracts from a CSV folder, where an empty end date means an ongoing one."""
    catalog = _stored("csv", fact_rental_contracts=Testbed(spark, root).customer_rentals())
    return present(staging.stage(catalog, "stg_rental_contracts").drop("actual_usage_hours"))


@report
def staged_orders(spark, root):
    catalog = _stored("parquet", fact_maintenance_events=Testbed(spark, root).work_orders())
    return present(staging.stage(catalog, "stg_maintenance_events").select(
        "work_order_id", "customer_id", "source_signal_id", "scheduled_date", "total_cost", "status", "is_predictive_sourced"))


@report
def staged_telemetry(spark, root):
    catalog = _stored("csv", fact_telemetry_daily=_telemetry(Testbed(spark, root)))
    return present(staging.stage(catalog, "stg_telemetry_daily"))


@report
def staged_faults(spark, root):
    """Fault events from a CSV folder whose files also name the component at fault, which no scan may show."""
    events = Testbed(spark, root).fault_events()
    told = events.withColumn("component_id", (F.pmod("event_id", F.lit(12)) + 1))
    path = scratch_dir(spark, "told-faults")
    write_csv(told, path)
    return present(csv_scan(spark, "fact_fault_events", path).drop("ingested_at"))


@report
def staged_tables(spark, root):
    """The staging models that pass a table on: rows, columns, distinct keys and empty cells of each."""
    bed = Testbed(spark, root)
    chain = SignalChain(bed)
    given = {
        "stg_industries": bed.industries(), "stg_customers": bed.customers(), "stg_sites": bed.sites(), "stg_equipment": bed.equipment(),
        "stg_equipment_models": bed.models(), "stg_equipment_categories": bed.categories(), "stg_components": bed.components(),
        "stg_parts": bed.parts().withColumnRenamed("unit_cost_usd", "unit_cost"), "stg_technicians": bed.technicians(),
        "stg_maintenance_parts_used": bed.parts_used(), "stg_ml_signals": chain.triaged(), "stg_parts_demand_forecast": chain.demand(),
        "stg_parts_mapping_gaps": chain.gaps(),
    }
    catalog = _stored("parquet", **{staging.MODELS[name][0]: df for name, df in given.items()})
    out = None
    for name in given:
        staged, key = staging.stage(catalog, name), CONSTRAINTS[staging.MODELS[name][0]].key
        empty = F.sum(sum((F.col(c).isNull().cast("int") for c in staged.columns), F.lit(0)))
        row = staged.agg(F.count("*").alias("n_rows"), F.count_distinct(*key).alias("distinct_keys"), F.coalesce(empty, F.lit(0)).alias("empty_cells")).select(
            F.lit(name).alias("model"), "n_rows", F.lit(",".join(staged.columns)).alias("columns"), "distinct_keys", "empty_cells")
        out = row if out is None else out.unionByName(row)
    return present(out)


@report
def staged_tax_filings(spark, root):
    catalog = _stored("parquet", fact_tax_filings=FinanceInputs(spark, root).filings_alone())
    return present(staging.stage(catalog, "stg_tax_filings").drop("filing_id"))


@report
def revenue_of_three_tables(spark, root):
    """Revenue by customer, month and stream from the staged sales, rental and work order tables."""
    bed = Testbed(spark, root)
    catalog = _stored("parquet", fact_equipment_sales=bed.equipment_sales(), fact_rental_contracts=bed.customer_rentals(),
                      fact_maintenance_events=bed.work_orders())
    lines = finance.revenue_lines(*[
        staging.stage(catalog, m) for m in ("stg_equipment_sales", "stg_rental_contracts", "stg_maintenance_events")])
    return present(finance.revenue_by_stream_month(finance.monthly_lines(lines)))


@report
def tax_filings_quarterly(spark, root):
    lines = Testbed(spark, root).revenue_lines()
    return present(finance.quarterly_tax_filings(finance.monthly_lines(lines), AS_OF))


@report
def tax_allocated_to_month(spark, root):
    return present(FinanceInputs(spark, root).allocated(), {"revenue_share_of_quarter": 6})


@report
def tax_reconciliation(spark, root):
    inputs = FinanceInputs(spark, root)
    return present(finance.reconcile_allocation(inputs.filings(), inputs.allocated()))


@report
def finance_monthly(spark, root):
    return present(FinanceInputs(spark, root).monthly_finance())


@report
def customer_concentration(spark, root):
    return present(FinanceInputs(spark, root).concentration().orderBy("revenue_rank", "customer_id"))


@report
def top_n_share(spark, root):
    return present(finance.top_n_share(FinanceInputs(spark, root).concentration(), 3))


@report
def finance_rollup(spark, root):
    return present(finance.finance_rollup(FinanceInputs(spark, root).monthly_finance()))


@report
def rental_billing(spark, root):
    return present(finance.rental_billing(Testbed(spark, root).rental_contracts(), AS_OF))


# Service and fleet


@report
def branch_performance(spark, root):
    bed = Testbed(spark, root)
    result = service.branch_performance(bed.work_orders(technicians=True, tiers=True), bed.technicians())
    return present(result.orderBy("period_month", "branch"))


@report
def maintenance_type_ratio(spark, root):
    return present(service.maintenance_type_ratio(Testbed(spark, root).work_orders()))


@report
def work_order_costing(spark, root):
    bed = Testbed(spark, root)
    return present(service.work_order_costing(bed.work_orders(), bed.parts_used(), bed.parts(), bed.equipment_in_service()))


@report
def corrective_gaps(spark, root):
    return present(service.corrective_gaps(Testbed(spark, root).work_orders()))


def _telemetry(bed: Testbed) -> DataFrame:
    return telemetry.telemetry_daily_rollup(bed.faults(), bed.utilization())


def _fleet(bed: Testbed) -> DataFrame:
    return service.fleet_operations(
        bed.equipment(), bed.models(), bed.categories(), bed.customers(),
        _telemetry(bed), bed.work_orders(), bed.rentals_by_machine())


@report
def fleet_operations(spark, root):
    return present(_fleet(Testbed(spark, root)), {
        "avg_daily_utilization_hours": 6, "avg_mttr_hours": 6, "mtbf_days": 6})


@report
def ownership_split(spark, root):
    return present(service.ownership_split(_fleet(Testbed(spark, root))))


@report
def rental_use(spark, root):
    return present(service.rental_use(_fleet(Testbed(spark, root))))


@report
def active_windows_daily(spark, root):
    bed = Testbed(spark, root)
    contracts = bed.rental_contracts().withColumn("last_day", F.coalesce("end_date", F.lit(AS_OF)))
    return present(telemetry.active_windows_daily(contracts, "start_date", "last_day", ["rate_type"]))


@report
def orders_during_rentals(spark, root):
    """Each work order with every contract of its machine that runs on the scheduled day."""
    bed = Testbed(spark, root)
    orders = bed.work_orders().select("work_order_id", "equipment_id", "scheduled_date")
    rentals = bed.customer_rentals().select("rental_id", "equipment_id", "start_date", "end_date")
    return present(telemetry.stab(orders, rentals, ["equipment_id"], "scheduled_date", "start_date", "end_date"))


# Inventory


@report
def parts_consumption(spark, root):
    bed = Testbed(spark, root)
    return present(inventory.parts_consumption(bed.parts_used(), bed.work_orders()))


def _branch_consumption(bed: Testbed) -> DataFrame:
    used = inventory.parts_consumption(bed.parts_used(), bed.work_orders())
    return used.join(bed.branch_of_customer(), "customer_id", "left")


def _stock(bed: Testbed) -> DataFrame:
    history = inventory.history_days(bed.work_orders())
    return inventory.inventory_replenishment(bed.parts(), _branch_consumption(bed), history, bed.branches(), SNAPSHOT)


@report
def inventory_replenishment(spark, root):
    return present(_stock(Testbed(spark, root)))


def _warehouse(bed: Testbed, demand: DataFrame, integer_division: bool = False) -> DataFrame:
    used = inventory.parts_consumption(bed.parts_used(), bed.work_orders())
    return inventory.warehouse_inventory(staging.inventory(_stock(bed)), bed.parts(), used, demand, integer_division)


@report
def warehouse_inventory(spark, root):
    bed = Testbed(spark, root)
    return present(_warehouse(bed, SignalChain(bed).demand()))


@report
def warehouse_inventory_whole_units(spark, root):
    """The stock with units per day cut to whole ones before they are annualised."""
    bed = Testbed(spark, root)
    return present(_warehouse(bed, SignalChain(bed).demand(), integer_division=True))


@report
def baseline_demand(spark, root):
    bed = Testbed(spark, root)
    return present(inventory.baseline_demand(inventory.parts_consumption(bed.parts_used(), bed.work_orders()), 30))


@report
def parts_at_risk(spark, root):
    bed = Testbed(spark, root)
    return present(inventory.parts_at_risk(SignalChain(bed).demand(), _stock(bed)))


# Calendar and telemetry


@report
def calendar(spark, root):
    orders = Testbed(spark, root).raw("orders")
    day = F.col("o_orderdate").cast("date")
    return present(telemetry.calendar_between(orders, F.min(day), F.max(day)))


@report
def calendar_padded(spark, root):
    """The calendar with month names filled up to nine characters."""
    orders = Testbed(spark, root).raw("orders")
    day = F.col("o_orderdate").cast("date")
    return present(telemetry.calendar_between(orders, F.min(day), F.max(day), padded_names=True))


@report
def telemetry_daily_rollup(spark, root):
    return present(_telemetry(Testbed(spark, root)))


# Predictive maintenance


class FeatureInputs:
    def __init__(self, bed: Testbed):
        self.bed = bed

    def telemetry(self) -> DataFrame:
        return _telemetry(self.bed)

    def component_faults(self) -> DataFrame:
        return predictive.fault_component_daily(self.bed.faults(), self.bed.fault_bridge())

    def features(self, labelled: bool) -> DataFrame:
        bed = self.bed
        return predictive.labelled_features(
            bed.equipment(), bed.components(), self.telemetry(), bed.maintenance_marks(), self.component_faults(),
            bed.failures() if labelled else None)


@report
def fault_component_daily(spark, root):
    return present(FeatureInputs(Testbed(spark, root)).component_faults())


@report
def fault_trend(spark, root):
    bed = Testbed(spark, root)
    return present(predictive.fault_trend(FeatureInputs(bed).component_faults(), bed.components()))


@report
def dense_spine(spark, root):
    bed = Testbed(spark, root)
    return present(predictive.dense_spine(bed.equipment(), bed.components(), FeatureInputs(bed).telemetry()))


@report
def maintenance_asof(spark, root):
    bed = Testbed(spark, root)
    return present(predictive.maintenance_asof(FeatureInputs(bed).telemetry(), bed.maintenance_marks()))


@report
def rolling_features(spark, root):
    return present(FeatureInputs(Testbed(spark, root)).features(labelled=False))


@report
def failure_labels(spark, root):
    bed = Testbed(spark, root)
    spine = predictive.dense_spine(bed.equipment(), bed.components(), FeatureInputs(bed).telemetry())
    labelled = predictive.failure_labels(spine, bed.failures())
    return present(labelled.select("equipment_id", "component_id", "date_id", "label"))


@report
def time_split_label_rate(spark, root):
    bed = Testbed(spark, root)
    spine = predictive.dense_spine(bed.equipment(), bed.components(), FeatureInputs(bed).telemetry())
    labelled = predictive.failure_labels(spine, bed.failures())
    return present(predictive.label_rates(predictive.holdout_split(labelled, HOLDOUT_DAYS)), {"positive_rate": 6})


@report
def purged_split_label_rate(spark, root):
    """The split without the training days whose labels look into the test period, up to five of them."""
    bed = Testbed(spark, root)
    spine = predictive.dense_spine(bed.equipment(), bed.components(), FeatureInputs(bed).telemetry())
    labelled = predictive.failure_labels(spine, bed.failures())
    return present(predictive.label_rates(predictive.holdout_split(labelled, HOLDOUT_DAYS, 5)), {"positive_rate": 6})


@report
def recent_faults(spark, root):
    recent = predictive.recent_days(Testbed(spark, root).faults(), "event_date", 7)
    return present(recent.groupBy("equipment_id", "fault_code").agg(F.count("*").alias("n")))


_trained: dict[tuple[str, str], tuple] = {}


def _trained_model(spark: SparkSession, root: str):
    """The classifier and its evaluation, trained once per session and data folder; it is no larger than its trees."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _trained:
        labelled = FeatureInputs(Testbed(spark, root)).features(labelled=True)
        _trained[key] = model.train_and_evaluate(
            settle(labelled.select("date_id", "label", *FEATURES), "features"), HOLDOUT_DAYS)
    return _trained[key]


def _newest_features(spark: SparkSession, root: str) -> DataFrame:
    """The newest day's features, added to a store that holds the days before."""
    bed = Testbed(spark, root)
    store, days, inputs = _store_without(bed, 1)
    return store.add_day(days[0], bed.equipment(), bed.components(), *inputs)


@report
def gbt_scored(spark, root):
    fitted, _ = _trained_model(spark, root)
    return present(model.score_latest(_newest_features(spark, root), fitted))


@report
def gbt_score_checks(spark, root):
    """What must hold of the model's scores, whatever it learned: who is scored, when, from what, and what follows."""
    fitted, judged = _trained_model(spark, root)
    probability = F.col("failure_probability")
    status = F.when(probability >= 0.70, "Action Recommended").when(probability >= 0.40, "Watch").otherwise("New")
    return present(model.score_latest(_newest_features(spark, root), fitted).select(
        "equipment_id", "component_id", "scoring_date", "weighted_score_7d", F.col("critical_count_7d").cast("bigint"),
        probability.between(0, 1).cast("int").alias("is_probability"), (F.col("signal_status") == status).cast("int").alias("status_follows"),
        F.lit(sum(judged.confusion.values())).alias("held_out_rows")))


@report
def gbt_compiled(spark, root):
    """Whether the trees as an expression give the probability of the model's own vectors, row by row."""
    fitted, _ = _trained_model(spark, root)
    newest = settle(_newest_features(spark, root), "newest")
    keys = ["equipment_id", "component_id", "scoring_date"]
    theirs = model.score_latest(newest, fitted).select(*keys, F.col("failure_probability").alias("_vector"), F.col("signal_status").alias("_status"))
    both = model.score_day(newest, fitted).join(theirs, keys)
    return present(both.select(
        *keys, "weighted_score_7d", (F.abs(F.col("failure_probability") - F.col("_vector")) < 1e-9).cast("int").alias("probabilities_agree"),
        (F.col("signal_status") == F.col("_status")).cast("int").alias("statuses_agree")))


@report
def gbt_evaluation(spark, root):
    """The model on the held-out days: what is counted, and whether exact figures and Spark's own agree."""
    fitted, judged = _trained_model(spark, root)
    curve = settle(model.judge(fitted, FeatureInputs(Testbed(spark, root)).features(labelled=True), HOLDOUT_DAYS), "curve")
    area, at = evaluation.area_under_curve(curve), evaluation.figures_at(curve, 0.5)
    near = {"auc": judged.auc, "precision": judged.precision, "recall": judged.recall}
    both = area.select("*", *[at.select(c).scalar().alias(c) for c in at.columns])
    return present(both.select(
        "positives", "negatives", F.col("auc").between(0, 1).cast("int").alias("is_share"),
        # Spark's own area is taken over at most a thousand thresholds
        *[(F.abs(F.coalesce(F.col(c), F.lit(0.0)) - v) < 0.005).cast("int").alias(f"{c}_agrees") for c, v in near.items()]))


@report
def risk_threshold_curve(spark, root):
    """Every threshold of the fixed risk curve on the held-out days: hits, false alarms, misses, precision and recall."""
    return present(_risk_curve(spark, root).drop("positives", "negatives"), {"precision": 6, "recall": 6})


@report
def risk_evaluation(spark, root):
    """Area under the curve of the fixed risk curve, and precision and recall at one half."""
    curve = settle(_risk_curve(spark, root), "curve")
    at = evaluation.figures_at(curve, 0.5)
    both = evaluation.area_under_curve(curve).select("*", *[at.select(c).scalar().alias(c) for c in at.columns])
    return present(both, {"auc": 6, "precision": 6, "recall": 6})


def _risk_curve(spark: SparkSession, root: str) -> DataFrame:
    graded = FeatureInputs(Testbed(spark, root)).features(labelled=True).withColumn(
        "score", F.round(predictive.risk_score("weighted_score_7d", midpoint=9.0, steepness=0.5), 4))
    held_out = predictive.holdout_split(graded, HOLDOUT_DAYS).filter(F.col("split") == "test")
    return evaluation.threshold_curve(held_out.select("score", "label"), "score")


def _increment_inputs(bed: Testbed) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Telemetry, maintenance and component faults, each written once for all days."""
    inputs = FeatureInputs(bed)
    return (settle(inputs.telemetry(), "telemetry"), settle(bed.maintenance_marks().distinct(), "marks"),
            settle(inputs.component_faults(), "component-faults"))


def _store_without(bed: Testbed, last: int) -> tuple[FeatureStore, list, tuple[DataFrame, ...]]:
    """A store of all days but the ``last`` ones, these, and the inputs of all days."""
    readings, marks, faults = inputs = _increment_inputs(bed)
    days = [r["date_id"] for r in readings.select("date_id").distinct().orderBy(F.desc("date_id")).limit(last).collect()]
    before = min(days)
    store = FeatureStore(bed.spark, scratch_dir(bed.spark, "feature-store"))
    store.build(bed.equipment(), bed.components(), readings.filter(F.col("date_id") < before),
                marks.filter(F.col("scheduled_date") < before), faults.filter(F.col("date_id") < before))
    return store, sorted(days), inputs


@report
def feature_increments(spark, root):
    """The feature grid of all days but three, to which these are added one by one."""
    bed = Testbed(spark, root)
    store, days, inputs = _store_without(bed, 3)
    for day in days:
        store.add_day(day, bed.equipment(), bed.components(), *inputs)
    return present(store.read())


class SignalChain:
    """Signals and each step after them. The numbered and the triaged signals are written once and shared by all steps."""

    def __init__(self, bed: Testbed):
        self.bed = bed
        inputs = FeatureInputs(bed)
        days = settle(bed.telemetry_days(), "telemetry-days")
        latest = predictive.latest_scores(bed.equipment(), bed.components(), days, inputs.component_faults())
        scored = latest.withColumn(
            "failure_probability", F.round(predictive.risk_score("weighted_score_30d", midpoint=38.0, steepness=0.12), 4))
        codes = predictive.contributing_fault_codes(bed.faults(), bed.fault_bridge(), F.array_max(scalar_array(days, "date_id")))
        self.signals = predictive.signals_table(scored, CREATED_AT, "risk-v1", codes)

    @cached_property
    def _triaged(self) -> DataFrame:
        return settle(signals.apply_triage(
            self.signals, self.bed.equipment(), self.bed.customers(), self.bed.visits_2024()), "triaged")

    def triaged(self) -> DataFrame:
        return self._triaged

    def _catalog(self) -> tuple[DataFrame, ...]:
        return self.bed.equipment(), self.bed.component_parts(), self.bed.part_models(), self.bed.parts()

    def demand(self) -> DataFrame:
        return signals.parts_demand(self.triaged(), *self._catalog())

    def gaps(self) -> DataFrame:
        return signals.parts_gaps(self.triaged(), *self._catalog())

    def reviewed(self) -> DataFrame:
        return signals.review_signals(self.triaged())

    def new_orders(self, reviewed: DataFrame | None = None) -> DataFrame:
        last = self.bed.raw("orders").agg(F.max("o_orderkey")).scalar()
        decided = self.reviewed() if reviewed is None else reviewed
        return signals.predictive_work_orders(
            decided, self.bed.equipment(), self.bed.customers(), self.bed.technicians(),
            self.bed.branch_of_customer(), last)

    def enriched(self) -> DataFrame:
        bed = self.bed
        reviewed = settle(self.reviewed(), "reviewed")
        return signals.predictive_signals_enriched(
            reviewed, bed.equipment(), bed.customers(), bed.models(), bed.categories(), bed.components(),
            self.new_orders(reviewed))

    def catalog_gaps(self) -> DataFrame:
        bed = self.bed
        return signals.catalog_gaps(
            self.gaps(), self.signals, bed.equipment(), bed.customers(), bed.industries(), bed.components(), bed.models(),
            bed.categories())


@report
def risk_scored_signals(spark, root):
    chain = SignalChain(Testbed(spark, root))
    flat = chain.signals.withColumn("contributing_fault_codes", F.array_join("contributing_fault_codes", ","))
    return present(flat.drop("created_at"))


@report
def signals_stamped(spark, root):
    """Stored signals with the stamp and version of their run and the number of codes behind them."""
    catalog = _stored("parquet", ml_maintenance_signals=SignalChain(Testbed(spark, root)).signals)
    return present(staging.stage(catalog, "stg_ml_signals").select(
        "signal_id", "model_version", F.col("created_at").cast("date").alias("created_on"),
        F.coalesce(F.size("contributing_fault_codes"), F.lit(0)).alias("n_codes")))


@report
def confirmed_failures(spark, root):
    """Failures out of a stored calendar that holds false starts too."""
    catalog = _stored("parquet", failure_calendar=Testbed(spark, root).failure_calendar())
    return present(predictive.confirmed_failures(catalog.table("failure_calendar")))


@report
def secure_sites(spark, root):
    """Customers and their sites that each role can see."""
    bed = Testbed(spark, root)
    sites, result = bed.sites(), None
    for role in ("analyst", "analyst_asia", "analyst_west", "stranger", "etl"):
        view = governance.secure_view({"customers": bed.customers(), "sites": sites}, role, REGIONS_BY_ROLE)
        rows = view["sites"].groupBy("region").agg(F.count("*").alias("sites"), F.count_distinct("customer_id").alias("customers")).select(
            F.lit(role).alias("role"), "region", "customers", "sites")
        result = rows if result is None else result.unionByName(rows)
    return present(result)


@report
def fault_code_index(spark, root):
    """From code to signals, over signals stored with their lists."""
    catalog = _stored("parquet", ml_maintenance_signals=SignalChain(Testbed(spark, root)).signals)
    return present(signals.fault_code_index(catalog.table("ml_maintenance_signals")))


@report
def signals_triaged(spark, root):
    return present(SignalChain(Testbed(spark, root)).triaged().drop("created_at", "contributing_fault_codes"))


@report
def status_frequency(spark, root):
    return present(signals.status_frequency(SignalChain(Testbed(spark, root)).triaged()))


@report
def parts_demand(spark, root):
    return present(SignalChain(Testbed(spark, root)).demand())


@report
def parts_gaps(spark, root):
    return present(SignalChain(Testbed(spark, root)).gaps())


@report
def catalog_gaps(spark, root):
    return present(SignalChain(Testbed(spark, root)).catalog_gaps())


@report
def catalog_gaps_summary(spark, root):
    return present(signals.catalog_gaps_summary(SignalChain(Testbed(spark, root)).catalog_gaps()))


@report
def work_orders_converted(spark, root):
    return present(SignalChain(Testbed(spark, root)).new_orders())


@report
def work_orders_appended(spark, root):
    chain = SignalChain(Testbed(spark, root))
    every = signals.append_work_orders(chain.bed.work_orders(), chain.new_orders())
    return present(every.select("work_order_id", "equipment_id", "maintenance_type", "priority", "scheduled_date",
                                "downtime_hours", "total_cost", "status"))


@report
def predictive_signals_enriched(spark, root):
    return present(SignalChain(Testbed(spark, root)).enriched())


@report
def top_risk(spark, root):
    return present(signals.top_risk(SignalChain(Testbed(spark, root)).enriched(), 200))


@report
def signal_funnel(spark, root):
    return present(signals.signal_funnel(SignalChain(Testbed(spark, root)).enriched()))


def _outcomes(bed: Testbed) -> DataFrame:
    """The signals above New that the triage rule makes on each day of the grid, judged against later failures."""
    probability = F.round(predictive.risk_score("weighted_score_30d", midpoint=38.0, steepness=0.12), 4)
    risky = FeatureInputs(bed).features(labelled=False).filter(predictive.triage_status(probability) != "New").select(
        "equipment_id", F.col("component_id").alias("predicted_component_id"), F.col("date_id").alias("scoring_date"),
        predictive.lookup(predictive.C.ACTION_WINDOW_BY_COMPONENT, F.col("component_id")).alias("recommended_action_window_days"))
    numbered = number_rows(risky, ["scoring_date", "equipment_id", "predicted_component_id"], "signal_id")
    return signals.signal_outcomes(numbered, bed.failures(), bed.work_orders(), bed.last_day())


@report
def signal_outcomes(spark, root):
    return present(_outcomes(Testbed(spark, root)))


@report
def outcome_precision(spark, root):
    return present(signals.outcome_precision(_outcomes(Testbed(spark, root))), {"precision": 6, "avg_lead_time_days": 6})


@report
def risk_confusion(spark, root):
    """How the fixed risk curve does on the held-out days: rows per label and prediction."""
    graded = FeatureInputs(Testbed(spark, root)).features(labelled=True).withColumn(
        "prediction", (predictive.risk_score("weighted_score_7d", midpoint=9.0, steepness=0.5) >= 0.5).cast("int"))
    held_out = predictive.holdout_split(graded, HOLDOUT_DAYS).filter(F.col("split") == "test")
    return present(model.confusion_counts(held_out))


@report
def signal_visits(spark, root):
    return present(signals.merge_into_visits(SignalChain(Testbed(spark, root)).triaged()))


@report
def signals_expired(spark, root):
    aged = signals.expire_signals(SignalChain(Testbed(spark, root)).triaged(), F.lit("2024-02-12").cast("date"))
    return present(signals.status_frequency(aged))


# Governance and quality


@report
def secure_sales(spark, root):
    bed = Testbed(spark, root)
    sales = bed.revenue_lines().filter(F.col("revenue_stream") == "Equipment Sales")
    seen = governance.visible_through_customer(sales, bed.customers(), "analyst_asia", REGIONS_BY_ROLE)
    return present(seen.select("customer_id", "event_date", "amount"))


@report
def secure_tax_filings(spark, root):
    inputs = FinanceInputs(spark, root)
    return present(governance.visible_through_customer(
        inputs.filings(), inputs.bed.customers(), "analyst_west", REGIONS_BY_ROLE))


@report
def secure_row_counts(spark, root):
    """Customers and sales each role can see."""
    bed = Testbed(spark, root)
    customers = bed.customers()
    sales = bed.revenue_lines().filter(F.col("revenue_stream") == "Equipment Sales").groupBy("customer_id").agg(
        F.count("*").alias("n"))
    result = None
    for role in ("analyst", "analyst_asia", "analyst_west", "stranger", "etl"):
        view = governance.secure_view({"customers": customers, "sales": sales}, role, REGIONS_BY_ROLE)
        row = view["customers"].agg(F.count("*").alias("customers")).select(
            F.lit(role).alias("role"), "customers",
            F.coalesce(view["sales"].agg(F.sum("n")).scalar(), F.lit(0)).alias("sales"))
        result = row if result is None else result.unionByName(row)
    return present(result)


@report
def audit_diff(spark, root):
    """Customers, all their columns, against a version with some rows removed, some changed and some added."""
    before = Testbed(spark, root).raw("customer")
    key = F.col("c_custkey")
    kept = before.filter(F.pmod(key, F.lit(17)) != 0).withColumn(
        "c_acctbal", F.when(F.pmod(key, F.lit(13)) == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))).withColumn(
        "c_mktsegment", F.when(F.pmod(key, F.lit(11)) == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment")))
    added = before.filter(F.pmod(key, F.lit(19)) == 0).withColumn("c_custkey", key + 1000000000)
    log = governance.audit_diff(before, kept.unionByName(added), ["c_custkey"], "customer", "loader", CREATED_AT)
    balance, segment = "$.c_acctbal", "$.c_mktsegment"
    return present(log.select(
        "c_custkey", "table_name", "operation", "db_user",
        F.round(F.get_json_object("old_data", balance).cast("double"), 2).alias("old_balance"),
        F.round(F.get_json_object("new_data", balance).cast("double"), 2).alias("new_balance"),
        F.get_json_object("old_data", segment).alias("old_segment"), F.get_json_object("new_data", segment).alias("new_segment")))


@report
def audit_four_tables(spark, root):
    """Changes of four tables in one log, each against a version with some rows removed, some changed and some added."""
    bed = Testbed(spark, root)
    logs = None
    for table, key, value in (("customer", "c_custkey", "c_acctbal"), ("orders", "o_orderkey", "o_totalprice"),
                              ("part", "p_partkey", "p_retailprice"), ("supplier", "s_suppkey", "s_acctbal")):
        before, at = bed.raw(table), F.col(key)
        kept = before.filter(F.pmod(at, F.lit(17)) != 0).withColumn(
            value, F.when(F.pmod(at, F.lit(13)) == 0, F.col(value) + 1).otherwise(F.col(value)))
        added = before.filter(F.pmod(at, F.lit(19)) == 0).withColumn(key, at + 1000000000)
        log = governance.audit_diff(before, kept.unionByName(added), [key], table, "loader", CREATED_AT).select(
            F.col(key).alias("row_key"), "table_name", "operation",
            *[F.round(F.get_json_object(f"{when}_data", f"$.{value}").cast("double"), 2).alias(f"{when}_value")
              for when in ("old", "new")])
        logs = log if logs is None else logs.unionByName(log)
    return present(logs)


@report
def audit_parts(spark, root):
    """The log of orders changed within two ranges of keys, comparing rows in the changed ranges alone."""
    before, at = Testbed(spark, root).raw("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), F.col("o_orderkey")
    near = at.between(300, 2900) | at.between(4000, 5100)
    kept = before.filter(~(near & (F.pmod(at, F.lit(17)) == 0))).withColumn(
        "o_totalprice", F.when(near & (F.pmod(at, F.lit(13)) == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    added = before.filter(near & (F.pmod(at, F.lit(19)) == 0)).withColumn("o_orderkey", -at)
    log = governance.audit_changed_parts(before, kept.unionByName(added), ["o_orderkey"], "orders", "loader", CREATED_AT, width=1000)
    return present(log.select("o_orderkey", "operation", *[
        F.round(F.get_json_object(f"{when}_data", "$.o_totalprice").cast("double"), 2).alias(f"{when}_price") for when in ("old", "new")]))


@report
def encrypt_rotation(spark, root):
    """Names under two keys, a quarter of them moved on to a third; read side by side, and with ciphertexts exchanged."""
    plain = Testbed(spark, root).raw("customer").select("c_custkey", "c_name")
    secrets = [(1, "0123456789abcdef"), (2, "fedcba9876543210"), (3, "0123456789abcdef0123456789abcdef")]
    keys = literal_frame(spark, "key_id int; secret string", secrets).withColumn("secret", F.col("secret").cast("binary"))
    bound = ("customer", ["c_custkey"])
    first = F.when(F.pmod("c_custkey", F.lit(2)) == 0, 1).otherwise(2)
    locked = settle(governance.encrypt_rows(plain, "c_name", keys, first, *bound), "locked")
    retired = locked.filter("c_custkey % 4 = 0")
    rotated = settle(locked.filter("c_custkey % 4 <> 0").unionByName(
        governance.rotate_key(retired, "c_name", keys, [1], 3, *bound)), "rotated")
    opened = governance.decrypt_rows(rotated, "c_name", keys, *bound, "decrypted")
    other = rotated.select((F.col("c_custkey") - 1).alias("c_custkey"), "c_name", "c_name_key")
    swapped = governance.decrypt_rows(other, "c_name", keys, *bound, "swapped").select("c_custkey", "swapped")
    without = governance.decrypt_rows(rotated, "c_name", keys.filter("key_id <> 2"), *bound, "without").select("c_custkey", "without")
    return present(opened.join(swapped, "c_custkey", "left").join(without, "c_custkey").select(
        "c_custkey", F.col("c_name_key").alias("key_id"), "decrypted", F.col("swapped").isNotNull().alias("swapped_opens"),
        F.col("without").isNotNull().alias("opens_without_key_2")))


@report
def encrypt_roundtrip(spark, root):
    customers = Testbed(spark, root).raw("customer").select("c_custkey", "c_name")
    key = F.lit("0123456789abcdef").cast("binary")
    locked = governance.encrypt_column(customers.withColumn("plain", F.col("c_name")), "c_name", key)
    opened = governance.decrypt_column(locked, "c_name", key, "decrypted")
    return present(opened.select(
        "c_custkey", "decrypted", (F.col("decrypted") == F.col("plain")).alias("matches"),
        F.octet_length("c_name").alias("cipher_bytes")))


@report
def quality_report(spark, root):
    bed = Testbed(spark, root)
    tables = {
        "customers": bed.customers(), "equipment": bed.equipment(), "work_orders": bed.work_orders(technicians=True),
        "order_lines": bed.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
    }
    rules = {
        "customers": Constraints(("customer_id",), ("customer_name", "region"), (("customer_name",),), {},
                                 {"contract_tier": ["Silver", "Gold", "Platinum"]}),
        "equipment": Constraints(("equipment_id",), ("model_id",), (("serial_number",),),
                                 {"customer_id": ("customers", "customer_id")},
                                 {"ownership_type": ["Owned", "Rented"], "status": ["Active", "Idle"]}),
        "work_orders": Constraints(("work_order_id",), ("technician_id", "actual_completion"), (),
                                   {"equipment_id": ("equipment", "equipment_id")},
                                   {"priority": ["Critical", "High", "Routine"]}),
        "order_lines": Constraints(("l_orderkey", "l_linenumber"), ("l_partkey",), (),
                                   {"l_orderkey": ("work_orders", "work_order_id")}, {},
                                   {"quantity at most 40": "l_quantity > 40"}),
    }
    return present(quality.check_constraints(
        {**tables, "work_orders": tables["work_orders"].withColumnRenamed("work_order_id", "l_orderkey")
         .withColumn("work_order_id", F.col("l_orderkey"))}, rules))


@report
def declared_constraints(spark, root):
    """The declared constraints over every table the given data can fill, with repeated machines and owners nobody knows."""
    bed = Testbed(spark, root)
    chain = SignalChain(bed)
    orders, day = bed.raw("orders"), F.col("o_orderdate").cast("date")
    machines = bed.equipment().withColumn("customer_id", F.when(
        F.pmod("equipment_id", F.lit(53)) == 0, F.col("customer_id") + 1000000000).otherwise(F.col("customer_id")))
    given = {
        "dim_industry": bed.industries(), "dim_customer": bed.customers(),
        "dim_equipment": machines.unionByName(machines.filter("equipment_id % 97 = 0")),
        "dim_equipment_model": bed.models(), "dim_equipment_category": bed.categories(), "dim_component": bed.components(),
        "dim_technician": bed.technicians(), "dim_part": bed.parts().withColumnRenamed("unit_cost_usd", "unit_cost"),
        "dim_date": telemetry.calendar_between(orders, F.min(day), F.max(day)), "bridge_component_part": bed.component_parts(),
        "bridge_faultcode_component": bed.fault_bridge(), "fact_equipment_sales": bed.equipment_sales(),
        "fact_rental_contracts": bed.customer_rentals(), "fact_telemetry_daily": _telemetry(bed), "fact_fault_events": bed.faults(),
        "fact_maintenance_events": bed.work_orders(), "fact_maintenance_parts_used": bed.parts_used(),
        "fact_tax_filings": FinanceInputs(spark, root).filings_alone(), "ml_maintenance_signals": settle(chain.triaged(), "signals"),
        "parts_demand_forecast": chain.demand(), "parts_mapping_gaps": chain.gaps(),
    }
    return present(quality.check_constraints({name: conform(df, name) for name, df in given.items()}))


def _changed(df: DataFrame, column: str, value, key: str, every: int) -> DataFrame:
    """A planted fault: another value in the rows whose key ``every`` divides."""
    return df.withColumn(column, F.when(F.pmod(F.col(key), F.lit(every)) == 0, F.lit(value)).otherwise(F.col(column)))


@report
def result_checks(spark, root):
    """The marts with planted faults: repeated machines, odd owners and branches, probabilities above one."""
    bed = Testbed(spark, root)
    inputs = FinanceInputs(spark, root)
    chain = SignalChain(bed)
    monthly_finance = settle(inputs.monthly_finance(), "finance-monthly")
    fleet = settle(_fleet(bed), "fleet")
    fleet = _changed(fleet.unionByName(fleet.filter("equipment_id % 97 = 0")), "ownership_type", "Borrowed", "equipment_id", 61)
    # results are tables: each is computed once and then read by its checks
    results = {
        "finance_monthly": monthly_finance,
        "customer_concentration": settle(inputs.concentration(monthly_finance), "concentration"),
        "fleet_operations": fleet,
        "predictive_signals": _changed(settle(chain.enriched(), "enriched"), "failure_probability", 1.5, "signal_id", 89),
        "warehouse_inventory": _changed(settle(_warehouse(bed, chain.demand()), "stock"), "branch", "Nowhere", "part_id", 83),
        "branch_performance": service.branch_performance(bed.work_orders(technicians=True, tiers=True), bed.technicians()),
        "catalog_gaps": settle(chain.catalog_gaps(), "catalog-gaps"),
    }
    return present(quality.check_results(results, bed.branches()))


@report
def machines_served(spark, root):
    """Distinct machines served by quarter and year from stored monthly sketches, against the exact numbers."""
    bed = Testbed(spark, root)
    orders, branches = bed.work_orders(), bed.branch_of_customer()
    sketches = settle(service.machine_sketches(orders, branches), "sketches")
    dated, out = orders.join(branches, "customer_id").withColumn("period_month", F.trunc("scheduled_date", "month")), None
    for grain in ("quarter", "year"):
        exact = dated.groupBy("branch", F.trunc("period_month", grain).alias("period_start")).agg(
            F.count_distinct("equipment_id").alias("exact"))
        # three standard errors, and one machine for rounding
        near = F.abs(F.col("machines") - F.col("exact")) <= F.col("exact") * (3 * 1.04 / 2 ** (service.SKETCH_BITS / 2)) + 1
        both = service.machines_served(sketches, grain).join(exact, ["branch", "period_start"]).select(
            F.lit(grain).alias("grain"), "branch", "period_start", "exact", near.cast("int").alias("within_bound"))
        out = both if out is None else out.unionByName(both)
    return present(out)


# Messages, streams and sinks


def _fault_messages(bed: Testbed) -> DataFrame:
    rows = bed.faults().select("equipment_id", "event_date", "fault_code", "severity")
    return as_messages(rows, "equipment_id")


@report
def json_publish(spark, root):
    return _fault_messages(Testbed(spark, root))


@report
def insert_if_absent(spark, root):
    customers = Testbed(spark, root).raw("customer").select("c_custkey", "c_name")
    existing = customers.filter(F.pmod(F.col("c_custkey"), F.lit(2)) == 0)
    offered = customers.withColumn("c_name", F.concat(F.lit("new "), "c_name"))
    return present(append_missing(offered, existing, ["c_custkey"]))


#: Batches in which a stream reads what was written for it, however many files that is.
BATCHES = 2


def _as_files(df: DataFrame, path: str) -> int:
    """Add rows to a folder as many files, no task writing more than its share, and say how many of them are a batch.

    There are as many files as a shuffle has partitions, since a few would each pass through one task.
    """
    a_batch = -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // BATCHES)
    df.repartition(BATCHES * a_batch).write.mode("append").parquet(path)
    return a_batch


def _spoiled(messages: DataFrame, every: int) -> DataFrame:
    """A share of the messages cut off in the middle."""
    cut = F.pmod(F.xxhash64("value"), F.lit(every)) == 0
    return messages.filter(cut).withColumn("value", F.expr("left(value, length(value) - 2)"))


@report
def stream_fault_append(spark, root):
    """Fault messages over several batches, some of them sent a second time cut off, which lands nowhere."""
    messages = _fault_messages(Testbed(spark, root))
    source = scratch_dir(spark, "fault-messages")
    a_batch = _as_files(messages.unionByName(_spoiled(messages, 5)), source)
    target, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "offsets")
    sink = FaultLanding(target)
    drain(sink.decode(file_source(spark, source, a_batch)), sink, checkpoint)
    return present(sink.read(spark).drop("batch_id"))


@report
def stream_upsert_daily(spark, root):
    """Half of the machine-days arrive with other hours and again cut off, then all of them as they are."""
    rows = settle(_telemetry(Testbed(spark, root)).drop("engine_hours"), "telemetry-rows")
    final = as_messages(rows, "equipment_id")
    early = as_messages(rows.filter(F.pmod("equipment_id", F.lit(2)) == 0).withColumn(
        "utilization_hours", F.lit(0).cast(rows.schema["utilization_hours"].dataType)), "equipment_id")
    target, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "offsets")
    source, sink = scratch_dir(spark, "telemetry-messages"), TelemetryLanding(target)
    for messages in (early.unionByName(_spoiled(final, 3)), final):
        a_batch = _as_files(messages, source)
        drain(sink.decode(file_source(spark, source, a_batch)), sink, checkpoint)
    return present(sink.read(spark).drop("engine_hours"))


@report
def streams_landed(spark, root):
    """Both topics landed in one job, with some messages cut off: what each landed and put aside, counted on the way."""
    bed = Testbed(spark, root)
    out, cut = scratch_dir(spark, "landed"), F.pmod(F.col("key").cast("bigint"), F.lit(5)) == 0
    sources = []
    for name, messages in (("faults", _fault_messages(bed)),
                           ("telemetry", as_messages(_telemetry(bed).drop("engine_hours"), "equipment_id"))):
        short = messages.filter(cut).withColumn("value", F.expr("left(value, length(value) - 2)"))
        source = scratch_dir(spark, name)
        sources.append(file_source(spark, source, _as_files(messages.unionByName(short), source)))
    faults, days = land_streams(*sources, out, scratch_dir(spark, "offsets"))
    counts = faults.counts.read(spark).unionByName(days.counts.read(spark))
    stored = faults.read(spark).select(F.lit("faults").alias("topic")).unionByName(
        days.read(spark).select(F.lit("telemetry_daily").alias("topic"))).groupBy("topic").agg(F.count("*").alias("stored"))
    return present(counts.groupBy("topic").agg(F.sum("landed").alias("landed"), F.sum("quarantined").alias("quarantined")).join(stored, "topic"))


@report
def stream_daily_rollup(spark, root):
    bed = Testbed(spark, root)
    target, checkpoint = scratch_dir(spark, "rollup"), scratch_dir(spark, "offsets")
    sink = KeyedUpsert(target, "daily_faults", DAILY, ["equipment_id", "date_id"], COUNTS)
    query = (
        daily_fault_rollup(bed.fault_stream()).writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return present(sink.read(spark))


def _scattered_events(bed: Testbed, batches: int) -> tuple[str, int]:
    """The events in files for some batches, every one with rows of all days, so that most come late, and the files of a batch.

    Each batch writes its days anew, so their number must not grow with the files.
    """
    path = scratch_dir(bed.spark, "scattered-events")
    rows = settle(bed.fault_rows(), "events")
    for n in range(batches):
        rows.filter(F.pmod(F.xxhash64("equipment_id", "ts"), F.lit(batches)) == n).write.mode("append").parquet(path)
    return path, -(-len(bed.spark.read.parquet(path).inputFiles()) // batches)


@report
def stream_late_rollup(spark, root):
    """Daily counts from events out of order, with a state of two days: late rows are counted from the log."""
    path, a_batch = _scattered_events(Testbed(spark, root), 4)
    events = spark.readStream.schema("equipment_id BIGINT, ts TIMESTAMP, severity STRING, reading DOUBLE").option(
        "maxFilesPerTrigger", a_batch).parquet(path)
    rollup = LateRollup(scratch_dir(spark, "rollup"))
    rollup.run(events, scratch_dir(spark, "offsets"))
    return present(rollup.table.read(spark))


@report
def numbered_orders(spark, root):
    """Dense numbers over every order by date and key."""
    orders = Testbed(spark, root).raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return present(number_rows(orders, ["order_date", "o_orderkey"], "order_no"))
