"""The given order and event tables in the shape the plans expect.

Customers stand in for machines and their owners, orders for work orders, lineitems for revenue and parts,
suppliers for technicians, and events for faults. Every frame is a projection of a given table, or a join
of two.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetworks import constants as C
from fleetworks.functions import lookup
from fleetworks.sources.literals import literal_frame

AS_OF = date(2001, 6, 30)
SNAPSHOT = date(2001, 8, 1)
HOLDOUT_DAYS = 10

TIER_BY_SEGMENT = {"MACHINERY": "Platinum", "AUTOMOBILE": "Gold", "BUILDING": "Silver"}
TYPE_BY_SEGMENT = {
    "MACHINERY": "Owner-Operator", "AUTOMOBILE": "Contract Miner", "BUILDING": "Construction Contractor",
    "FURNITURE": "Quarry Operator", "HOUSEHOLD": "Logistics/Energy",
}
INDUSTRY_BY_SEGMENT = {"MACHINERY": 1, "BUILDING": 2, "AUTOMOBILE": 3, "HOUSEHOLD": 4, "FURNITURE": 5}
STREAM_BY_FLAG = {"A": C.EQUIPMENT_SALES, "N": C.RENTAL, "R": C.SERVICE}
STATUS_BY_CODE = {"F": "Completed", "O": "Scheduled", "P": "In Progress"}
KIND_BY_PRIORITY = {"1-URGENT": "Corrective", "2-HIGH": "Predictive", "3-MEDIUM": "Inspection"}
RANK_BY_PRIORITY = {"1-URGENT": "Critical", "2-HIGH": "High"}
SEVERITY_BY_EVENT = {"error": "Critical", "purchase": "Warning", "click": "Warning"}
REGIONS_BY_ROLE = {
    "analyst": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "analyst_asia": ["ASIA"],
    "analyst_west": ["AMERICA", "EUROPE"],
}


class Testbed:
    """Canonical inputs over one data folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    # dimensions

    def regions_of_nations(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")

    def industries(self) -> DataFrame:
        names = {1: "Mining", 2: "Construction", 3: "Oil & Gas", 4: "Energy/Power", 5: "Quarrying"}
        return literal_frame(self.spark, "industry_id int; industry_name string", list(names.items()))

    def customers(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.raw("customer").join(
            self.regions_of_nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            lookup(TYPE_BY_SEGMENT, segment).alias("customer_type"),
            lookup(INDUSTRY_BY_SEGMENT, segment).alias("industry_id"), F.col("r_name").alias("region"),
            lookup(TIER_BY_SEGMENT, segment, C.DEFAULT_TIER).alias("contract_tier"))

    def equipment(self) -> DataFrame:
        key = F.col("c_custkey")
        last = F.pmod(key, F.lit(10))
        return self.raw("customer").select(
            key.alias("equipment_id"), F.col("c_nationkey").alias("model_id"),
            F.format_string("MG%02d%05d", F.col("c_nationkey"), key).alias("serial_number"),
            key.alias("customer_id"), F.col("c_nationkey").alias("site_id"),
            F.date_add(F.lit(date(2023, 12, 15)), F.pmod(key, F.lit(40)).cast("int")).alias("install_date"),
            F.when(F.pmod(key, F.lit(7)) == 0, "Rented").otherwise("Owned").alias("ownership_type"),
            F.when(last == 9, "Decommissioned").when(last == 8, "Idle").otherwise("Active").alias("status"))

    def equipment_in_service(self) -> DataFrame:
        """Machines with installation dates in the years the orders cover."""
        early = F.date_add(F.lit(date(1995, 1, 1)), F.pmod(F.col("equipment_id"), F.lit(1500)).cast("int"))
        return self.equipment().withColumn("install_date", early)

    def models(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("model_id"), F.col("n_regionkey").alias("category_id"),
                                         F.col("n_name").alias("model_name"))

    def categories(self) -> DataFrame:
        key = F.pmod(F.col("r_regionkey"), F.lit(3))
        return self.raw("region").select(
            F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category_name"),
            F.when(key == 0, "Mining").when(key == 1, "Construction").otherwise("Both").alias("primary_application"))

    def components(self) -> DataFrame:
        return literal_frame(self.spark, "component_id int; component_name string; system_category string", [
            (1, "Hydraulic Pump", "Hydraulics"), (2, "Fuel Injector", "Engine"), (12, "ECM/Sensor Module", "Electrical"),
        ])

    def fault_bridge(self) -> DataFrame:
        return literal_frame(self.spark, "fault_code string; component_id int; correlation_weight decimal(4,3)", [
            ("error", 1, "0.900"), ("error", 2, "0.600"), ("purchase", 2, "0.800"), ("click", 1, "0.500"),
            ("view", 12, "0.150"), ("view", 2, "0.100"), ("signup", 12, "0.700"),
        ])

    def component_parts(self) -> DataFrame:
        """Component 2 also maps to a category no part has, which forces catalogue gaps."""
        return literal_frame(
            self.spark, "component_id int; part_category string; typical_qty int; is_primary boolean", [
                (1, "ECONOMY", 1, True), (1, "SMALL", 2, False), (2, "MEDIUM", 1, True), (2, "UNLISTED", 1, False),
                (12, "LARGE", 1, True),
            ])

    def technicians(self) -> DataFrame:
        return self.raw("supplier").join(
            self.regions_of_nations(), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        ).select(F.col("s_suppkey").alias("technician_id"), F.col("s_name").alias("technician_name"),
                 F.col("r_name").alias("branch"))

    def parts(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("part_id"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("part_number"),
            F.col("p_name").alias("part_name"), F.col("p_type").alias("part_category"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("unit_cost_usd"),
            (F.pmod(F.col("p_partkey"), F.lit(33)) + 3).cast("int").alias("lead_time_days"))

    def part_models(self) -> DataFrame:
        """Part and model fit each other when their keys add up to a multiple of three."""
        models = self.raw("nation").select(
            F.col("n_nationkey").alias("model_id"), F.pmod(-F.col("n_nationkey"), F.lit(3)).cast("int").alias("_class"))
        parts = self.raw("part").select(
            F.col("p_partkey").alias("part_id"), F.pmod("p_partkey", F.lit(3)).cast("int").alias("_class"))
        return parts.join(models, "_class").select("part_id", "model_id")

    # revenue and work orders

    def line_dates(self) -> DataFrame:
        """Lineitems with their customer: one join, behind every revenue result."""
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate")
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def revenue_lines(self) -> DataFrame:
        amount = F.col("l_extendedprice").cast("decimal(18,2)")
        stream = lookup(STREAM_BY_FLAG, F.col("l_returnflag"))
        return self.line_dates().select(
            F.col("o_custkey").alias("customer_id"), F.col("l_shipdate").cast("date").alias("event_date"),
            stream.alias("revenue_stream"), amount.alias("amount"),
            F.when(F.col("l_returnflag") == "A", F.round(amount * F.lit("0.8").cast("decimal(2,1)"), 2))
            .cast("decimal(18,2)").alias("cost"),
            F.when(F.col("l_returnflag") == "R",
                   F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Scheduled")).alias("status"))

    def rental_contracts(self) -> DataFrame:
        """Each N lineitem as a contract. Some never end; a line's length follows its quantity."""
        start = F.col("l_shipdate").cast("date")
        number = F.col("l_linenumber")
        open_ended = (F.col("l_linestatus") == "O") & (F.pmod(number, F.lit(3)) == 0)
        return self.raw("lineitem").filter(F.col("l_returnflag") == "N").select(
            F.col("l_orderkey").alias("rental_id"), number.alias("line_number"), start.alias("start_date"),
            F.when(~open_ended, F.date_add(start, (F.col("l_quantity") * 7).cast("int"))).alias("end_date"),
            F.when(F.pmod(number, F.lit(2)) == 0, "Daily").otherwise("Monthly").alias("rate_type"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("rate"))

    def rentals_by_machine(self) -> DataFrame:
        """N lineitems as billed contracts of the ordering customer's machine."""
        return self.line_dates().filter(F.col("l_returnflag") == "N").select(
            F.col("o_custkey").alias("equipment_id"), F.col("o_custkey").alias("customer_id"),
            F.col("l_shipdate").cast("date").alias("start_date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("total_billed"),
            F.round(F.col("l_extendedprice").cast("decimal(18,2)") / F.lit(100).cast("decimal(5,0)"), 1)
            .cast("decimal(18,1)").alias("actual_usage_hours"))

    def equipment_sales(self) -> DataFrame:
        """A lineitems as sales to the ordering customer."""
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        return self.line_dates().filter(F.col("l_returnflag") == "A").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"), F.col("o_custkey").alias("equipment_id"),
            F.col("o_custkey").alias("customer_id"), F.col("l_shipdate").cast("date").alias("sale_date"),
            price.alias("sale_price"),
            F.round(price * F.lit("0.8").cast("decimal(2,1)"), 2).cast("decimal(14,2)").alias("cost_basis"))

    def customer_rentals(self) -> DataFrame:
        """The contracts of ``rental_contracts`` with their customer, billed at their rate."""
        contracts = self.rental_contracts()
        orders = self.raw("orders").select(F.col("o_orderkey").alias("_order"), "o_custkey")
        return contracts.join(orders, F.col("rental_id") == F.col("_order")).select(
            (F.col("rental_id") * 10 + F.col("line_number")).alias("rental_id"), F.col("o_custkey").alias("equipment_id"),
            F.col("o_custkey").alias("customer_id"), "start_date", "end_date", "rate_type", "rate",
            F.col("rate").alias("total_billed"))

    def work_orders(self, technicians: bool = False, tiers: bool = False) -> DataFrame:
        """Orders as work orders. The technician and the service level need a join each, so both are optional."""
        key = F.col("o_orderkey")
        busy = F.pmod(key * 7, F.lit(60))
        done = F.pmod(key, F.lit(11)) != 0
        start = F.col("o_orderdate").cast("timestamp") + F.expr("interval 8 hours")
        priority = F.col("o_orderpriority")
        orders = self.raw("orders").select(
            key.alias("work_order_id"), F.col("o_custkey").alias("equipment_id"), F.col("o_custkey").alias("customer_id"),
            lookup(KIND_BY_PRIORITY, priority, "Preventive").alias("maintenance_type"),
            lookup(RANK_BY_PRIORITY, priority, "Routine").alias("priority"),
            F.when((priority == "2-HIGH") & (F.pmod(key, F.lit(2)) == 0), key).alias("source_signal_id"),
            F.col("o_orderdate").cast("date").alias("scheduled_date"), start.alias("actual_start"),
            F.when(done, F.timestamp_micros(F.unix_micros(start) + busy * F.lit(3600000000).cast("bigint")))
            .alias("actual_completion"),
            F.when(done, busy).cast("decimal(6,1)").alias("downtime_hours"),
            (F.pmod(key, F.lit(40)) / F.lit(4)).cast("decimal(6,1)").alias("labor_hours"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total_cost"),
            (F.pmod(key, F.lit(5)) == 0).alias("warranty_flag"),
            lookup(STATUS_BY_CODE, F.col("o_orderstatus")).alias("status"))
        if technicians:
            crew = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("work_order_id")).agg(
                F.min("l_suppkey").alias("technician_id"))
            orders = orders.join(crew, "work_order_id", "left")
        if tiers:
            tier = lookup(TIER_BY_SEGMENT, F.col("c_mktsegment"), C.DEFAULT_TIER)
            hours = self.raw("customer").select(
                F.col("c_custkey").alias("customer_id"),
                lookup(C.SLA_HOURS_BY_TIER, tier, C.DEFAULT_SLA_HOURS).cast("decimal(6,1)").alias("sla_target_hours"))
            orders = orders.join(hours, "customer_id", "left")
        return orders.withColumn("is_predictive_sourced", F.col("source_signal_id").isNotNull())

    def parts_used(self) -> DataFrame:
        """Quantities per order and part; lines repeat, so they are summed."""
        return self.raw("lineitem").groupBy(
            F.col("l_orderkey").alias("work_order_id"), F.col("l_partkey").alias("part_id")
        ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty_used"))

    def branch_of_customer(self) -> DataFrame:
        return self.customers().select("customer_id", F.col("region").alias("branch"))

    def branches(self) -> Column:
        return self.raw("region").select(F.array_sort(F.collect_set("r_name"))).scalar()

    # telemetry

    def faults(self) -> DataFrame:
        code = F.col("event_type")
        return self.raw("events").select(
            F.col("user_id").alias("equipment_id"), F.col("ts").cast("date").alias("event_date"), code.alias("fault_code"),
            lookup(SEVERITY_BY_EVENT, code, "Info").alias("severity"), F.col("value").alias("reading"))

    def utilization(self) -> Column:
        """Hours of a machine-day, estimated at half an hour an event up to a full day."""
        return F.least(F.lit(24.0), F.count("*") * F.lit(0.5))

    def last_day(self) -> Column:
        return self.faults().agg(F.max("event_date")).scalar()

    def _as_faults(self, events: DataFrame) -> DataFrame:
        """Events with a real timestamp for watermarks."""
        as_utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
        return events.select(
            F.col("user_id").alias("equipment_id"), as_utc.alias("ts"),
            lookup(SEVERITY_BY_EVENT, F.col("event_type"), "Info").alias("severity"), F.col("value").alias("reading"))

    def fault_rows(self) -> DataFrame:
        return self._as_faults(self.raw("events"))

    def fault_stream(self, files_per_batch: int = 1000) -> DataFrame:
        """The events file read as a stream."""
        schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
        return self._as_faults(
            self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{self.root}/events*.parquet"))

    def maintenance_marks(self) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == "signup").select(
            F.col("user_id").alias("equipment_id"), F.col("ts").cast("date").alias("scheduled_date"))

    def failures(self) -> DataFrame:
        component = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(12)), (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int"))
        return self.raw("events").filter((F.col("event_type") == "error") & (F.col("value") >= 150)).select(
            F.col("user_id").alias("equipment_id"), component.alias("component_id"),
            F.col("ts").cast("date").alias("failure_date"))

    def failure_calendar(self) -> DataFrame:
        """Every error event as a failure, or as a false start if its reading is low."""
        component = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(12)), (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int"))
        return self.raw("events").filter(F.col("event_type") == "error").select(
            F.col("event_id").alias("calendar_id"), F.col("user_id").alias("equipment_id"), component.alias("component_id"),
            F.when(F.col("value") >= 150, C.FAILURE).otherwise("False Start").alias("event_type"),
            F.col("ts").cast("date").alias("failure_date"))

    def sites(self) -> DataFrame:
        """A site for each customer, and a second one for every third."""
        owners = self.customers().select("customer_id", "region", F.explode(F.expr(
            "CASE WHEN customer_id % 3 = 0 THEN array(0, 1) ELSE array(0) END")).alias("_n"))
        return owners.select((F.col("customer_id") * 10 + F.col("_n")).alias("site_id"),
                             F.concat(F.lit("Site "), (F.col("customer_id") * 10 + F.col("_n")).cast("string")).alias("site_name"),
                             "customer_id", "region")

    def fault_events(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id"), F.col("user_id").alias("equipment_id"), F.col("ts").cast("date").alias("event_date"),
                                         F.col("event_type").alias("fault_code"), lookup(SEVERITY_BY_EVENT, F.col("event_type"), "Info").alias("severity"))

    def telemetry_days(self) -> DataFrame:
        """The dates that have telemetry, one row each: a calendar, however many events there are."""
        return self.faults().select(F.col("event_date").alias("date_id")).distinct()

    def visits_2024(self) -> DataFrame:
        """Open work orders moved into the telemetry month, so that triage has visits to find."""
        shifted = F.date_add(F.lit(date(2024, 1, 28)), F.pmod(F.col("work_order_id"), F.lit(400)).cast("int"))
        return self.work_orders().withColumn("scheduled_date", shifted)
