"""Revenue, tax and concentration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetworks import constants as C
from fleetworks.functions import coin, elapsed_months, month_start, prorate, quarter_end, quarter_start
from fleetworks.operators import conditional_pivot, expand_months, rank_and_accumulate, share_of_group
from fleetworks.session import settle

MONEY = "decimal(18,2)"
TOTAL = "decimal(20,2)"


def revenue_lines(sales: DataFrame, rentals: DataFrame, work_orders: DataFrame) -> DataFrame:
    """The three revenue streams as one frame of dated amounts.

    A rental is booked whole on its start date. Service lines keep their order's status, because tax is
    filed on every order while revenue counts completed ones.
    """
    none = F.lit(None)
    parts = [
        sales.select("customer_id", F.col("sale_date").alias("event_date"),
                     F.lit(C.EQUIPMENT_SALES).alias("revenue_stream"), F.col("sale_price").cast(MONEY).alias("amount"),
                     F.col("cost_basis").cast(MONEY).alias("cost"), none.cast("string").alias("status")),
        rentals.select("customer_id", F.col("start_date").alias("event_date"),
                       F.lit(C.RENTAL).alias("revenue_stream"), F.col("total_billed").cast(MONEY).alias("amount"),
                       none.cast(MONEY).alias("cost"), none.cast("string").alias("status")),
        work_orders.select("customer_id", F.col("scheduled_date").alias("event_date"),
                           F.lit(C.SERVICE).alias("revenue_stream"), F.col("total_cost").cast(MONEY).alias("amount"),
                           none.cast(MONEY).alias("cost"), "status"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _cents(amount: Column) -> Column:
    """Money with two decimals as whole cents in a long; what does not fit one fails."""
    return (amount * 100).cast("bigint")


def _summed(amount: Column) -> Column:
    """The exact sum of money of at most 18 digits.

    Sums per key are held in longs: decimals beyond 18 digits are read from and written to bytes for every row. Cents are
    summed in two parts, so that neither sum can overflow.
    """
    cents, part = _cents(amount), F.lit(10**9)
    whole = F.sum(F.call_function("div", cents, part)).cast("decimal(20,0)") * part + F.sum(cents % part)
    return (whole * F.lit("0.01").cast("decimal(2,2)")).cast(TOTAL)


def monthly_lines(lines: DataFrame) -> DataFrame:
    """Revenue lines summed per customer, month, stream and status.

    Every finance result derives from this frame, so the lines themselves are scanned and shuffled once.
    """
    return lines.groupBy(
        "customer_id", month_start(F.col("event_date")).alias("period_month"), "revenue_stream", "status"
    ).agg(_summed(F.col("amount")).alias("amount"), _summed(F.col("cost")).alias("cost"))


#: Monthly rows that one task holds. What is sorted at once in a task is some times as many.
ROWS_A_TASK = 150_000


def by_customer(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Rows placed by customer in a stated number of partitions, which grows with the rows.

    Sums per month or quarter and windows on a customer's rows then find them where they are. Meant for settled monthly rows:
    they are counted first, and their number per customer is bounded by the months of history, however hot the customer is.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // rows_a_task)), "customer_id")


def earned(frame: DataFrame) -> DataFrame:
    """Rows that count as revenue: all sales and rentals, service once completed."""
    return frame.filter((F.col("revenue_stream") != C.SERVICE) | (F.col("status") == "Completed"))


def revenue_rows(monthly: DataFrame) -> DataFrame:
    """Revenue with possibly several rows per customer, month and stream.

    Allocation and pivot sum what they read, so handing them these rows saves the shuffle of summing first.
    """
    return earned(monthly).select("customer_id", "period_month", "revenue_stream", F.col("amount").alias("revenue"))


def revenue_by_stream_month(monthly: DataFrame) -> DataFrame:
    """(customer, month, stream) revenue from ``monthly_lines``."""
    return revenue_rows(monthly).groupBy("customer_id", "period_month", "revenue_stream").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"))


def sales_margin_by_month(monthly: DataFrame) -> DataFrame:
    sales = monthly.filter(F.col("revenue_stream") == C.EQUIPMENT_SALES)
    return sales.groupBy("customer_id", "period_month").agg(
        F.sum("cost").cast(TOTAL).alias("equipment_sales_cost"),
        (F.sum("amount") - F.sum("cost")).cast(TOTAL).alias("equipment_sales_margin"),
    )


def quarterly_tax_filings(monthly: DataFrame, as_of: date, overdue_rate: float = 0.06) -> DataFrame:
    """One filing per customer and quarter with taxable revenue.

    VAT and both levies apply to the whole base, withholding by kind of supply. Works count every order
    whatever its status. A past quarter is Overdue for a repeatable ``overdue_rate`` share of filings.
    """
    def of(stream: str) -> Column:
        cents = F.sum(F.when(F.col("revenue_stream") == stream, _cents(F.col("amount"))).otherwise(F.lit(0)))
        return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)

    bases = monthly.groupBy("customer_id", quarter_start(F.col("period_month")).alias("period_start")).agg(
        of(C.EQUIPMENT_SALES).alias("goods"), of(C.RENTAL).alias("services"), of(C.SERVICE).alias("works"))

    def rate(value: str) -> Column:
        return F.lit(value).cast("decimal(4,3)")

    def levy(amount: Column) -> Column:
        return F.bround(amount, 2).cast(MONEY)

    taxable = F.col("taxable")
    withholding = (F.col("goods") * rate(C.WITHHOLDING_GOODS) + F.col("services") * rate(C.WITHHOLDING_SERVICES)
                   + F.col("works") * rate(C.WITHHOLDING_WORKS))
    filing_key = F.col("customer_id") * 1000 + F.year("period_start") * 4 + F.quarter("period_start")
    status = (
        F.when(F.col("period_end") >= F.lit(as_of), "Pending")
        .when(coin(filing_key, 3, overdue_rate), "Overdue").otherwise("Filed")
    )
    return (
        bases.withColumn("taxable", (F.col("goods") + F.col("services") + F.col("works")).cast(MONEY))
        .filter(taxable > 0)
        .withColumn("period_end", quarter_end(F.col("period_start")))
        .select("customer_id", "period_start", "period_end",
                levy(taxable * rate(C.VAT_RATE)).alias("vat_amount"),
                levy(taxable * rate(C.NHIL_RATE)).alias("nhil_amount"),
                levy(taxable * rate(C.GETFUND_RATE)).alias("getfund_amount"),
                levy(withholding).alias("withholding_tax_amount"),
                status.alias("filing_status"))
    )


def allocate_period_to_month(filings: DataFrame, revenue: DataFrame) -> DataFrame:
    """Spread each quarterly filing over its months by the month's share of the quarter's revenue.

    A quarter without revenue is split evenly. Amounts are rounded to cents; the leftover cent stays out.
    """
    monthly = revenue.groupBy("customer_id", "period_month").agg(F.sum("revenue").cast(TOTAL).alias("month_revenue"))
    # a customer's months as one map, no longer than the history: rows that are placed by customer stay where they are
    earned_in = F.map_from_entries(F.collect_list(F.struct("period_month", "month_revenue")))
    of_customer = monthly.filter(F.col("period_month").isNotNull()).groupBy("customer_id").agg(earned_in.alias("_earned_in"))
    months = expand_months(filings.join(of_customer, "customer_id", "left"), F.col("period_start"), 3, "period_month")
    joined = (
        months.withColumn("month_revenue", F.coalesce(F.try_element_at("_earned_in", F.col("period_month")), F.lit(0)).cast(TOTAL))
        .drop("_earned_in")
        .withColumn("quarter_revenue", share_of_group("month_revenue", ["customer_id", "period_start"]).cast(TOTAL))
    )
    # without revenue the quarter splits evenly: one part of three
    empty = F.coalesce(F.col("quarter_revenue") <= 0, F.lit(True))
    part_of = F.when(empty, F.lit(1)).otherwise(F.col("month_revenue")).cast(MONEY)
    whole = F.when(empty, F.lit(3)).otherwise(F.col("quarter_revenue")).cast(MONEY)

    def part(amount: str) -> Column:
        return prorate(F.col(amount), part_of, whole)

    return joined.withColumn("revenue_share_of_quarter", (part_of / whole).cast("decimal(21,18)")).select(
        "customer_id", "period_month", F.col("period_start").alias("quarter_start"),
        F.col("period_end").alias("quarter_end"), "filing_status", "revenue_share_of_quarter",
        part("vat_amount").alias("vat_amount_allocated"),
        part("nhil_amount").alias("nhil_amount_allocated"),
        part("getfund_amount").alias("getfund_amount_allocated"),
        part("withholding_tax_amount").alias("withholding_tax_allocated"),
    )


def reconcile_allocation(filings: DataFrame, allocated: DataFrame, tolerance: str = "0.02") -> DataFrame:
    """Allocated minus filed amounts per filing, and whether every one is within the rounding tolerance."""
    taxes = ["vat", "nhil", "getfund", "withholding_tax"]
    names = {t: f"{t}_amount_allocated" if t != "withholding_tax" else "withholding_tax_allocated" for t in taxes}
    summed = allocated.groupBy("customer_id", F.col("quarter_start").alias("period_start")).agg(
        *[F.sum(names[t]).alias(f"{t}_sum") for t in taxes])
    limit = F.lit(tolerance).cast("decimal(6,2)")
    residuals = {t: (F.coalesce(f"{t}_sum", F.lit(0)) - F.col(f"{t}_amount")).cast(MONEY) for t in taxes}
    within = None
    for residual in residuals.values():
        ok = F.abs(residual) <= limit
        within = ok if within is None else within & ok
    return filings.join(summed, ["customer_id", "period_start"], "left").select(
        "customer_id", "period_start", *[r.alias(f"{t}_residual") for t, r in residuals.items()],
        within.alias("reconciles"))


def finance_monthly(revenue: DataFrame, allocated_tax: DataFrame, margin: DataFrame, customers: DataFrame,
                    industries: DataFrame) -> DataFrame:
    """One row per customer and month: revenue by stream, sales margin and allocated tax.

    Revenue is 0 in a month that only a filing covers; tax stays NULL in a month no filing covers; the
    margin percentage is NULL where nothing was sold. ``margin`` has at most one row per customer and month.
    """
    keys = ["customer_id", "period_month"]
    pivoted = conditional_pivot(revenue, keys, "revenue_stream", "revenue", {
        C.EQUIPMENT_SALES: "equipment_sales_revenue",
        C.RENTAL: "rental_revenue",
        C.SERVICE: "service_revenue",
    }).withColumnRenamed("total", "total_revenue")
    # an outer join of revenue with its margin and tax, as a union and a window: rows that are placed by customer stay
    # where they are; as in a join, a row with a NULL key meets no other
    earnings = [c for c in pivoted.columns if c not in keys]
    margins = ["equipment_sales_cost", "equipment_sales_margin"]
    rows = (
        pivoted.select(*keys, F.struct(*earnings).alias("_earned"))
        .unionByName(margin.select(*keys, F.struct(*margins).alias("_margin")), allowMissingColumns=True)
        .unionByName(allocated_tax.withColumn("_taxed", F.lit(True)), allowMissingColumns=True)
    )
    month = Window.partitionBy(*keys)
    matched = F.col("customer_id").isNotNull() & F.col("period_month").isNotNull()
    met = (
        rows.withColumn("_month_earned", F.when(matched, F.first("_earned", ignorenulls=True).over(month)).otherwise(F.col("_earned")))
        .withColumn("_month_margin", F.when(matched, F.first("_margin", ignorenulls=True).over(month)))
        .withColumn("_month_taxed", F.when(matched, F.max("_taxed").over(month)))
        .filter(F.col("_taxed") | (F.col("_earned").isNotNull() & F.col("_month_taxed").isNull()))
    )
    combined = met.select(
        *allocated_tax.columns, *[F.col(f"_month_earned.{c}").alias(c) for c in earnings],
        *[F.when(F.col("_month_earned").isNotNull(), F.col(f"_month_margin.{c}")).alias(c) for c in margins])

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(TOTAL)

    sold = amount("equipment_sales_revenue")
    output_tax = F.col("vat_amount_allocated") + F.col("nhil_amount_allocated") + F.col("getfund_amount_allocated")
    described = customers.join(industries, "industry_id", "left").select(
        F.col("customer_id").alias("dim_customer_id"), "customer_name", "customer_type", "contract_tier",
        "industry_id", "industry_name", "region")
    return combined.join(described, combined.customer_id == described.dim_customer_id, "left").select(
        F.col("dim_customer_id").alias("customer_id"), "customer_name", "customer_type", "contract_tier",
        "industry_id", "industry_name", "region", "period_month",
        F.quarter("period_month").alias("period_quarter"), F.year("period_month").alias("period_year"),
        sold.alias("equipment_sales_revenue"), amount("rental_revenue").alias("rental_revenue"),
        amount("service_revenue").alias("service_revenue"), amount("total_revenue").alias("total_revenue"),
        amount("equipment_sales_cost").alias("equipment_sales_cost"),
        amount("equipment_sales_margin").alias("equipment_sales_margin"),
        F.when(sold > 0, F.round(amount("equipment_sales_margin") * 100 / F.nullif(sold, F.lit(0)), 1))
        .cast("decimal(10,1)").alias("equipment_sales_margin_pct"),
        F.col("quarter_start").alias("filing_quarter_start"), F.col("quarter_end").alias("filing_quarter_end"),
        "filing_status", "vat_amount_allocated", "nhil_amount_allocated", "getfund_amount_allocated",
        output_tax.cast(MONEY).alias("total_output_tax_allocated"), "withholding_tax_allocated",
    )


def customer_concentration(finance: DataFrame, customers: DataFrame, industries: DataFrame) -> DataFrame:
    """All-time revenue per customer with its rank, share and cumulative share of the whole.

    Customers with equal revenue share a rank; the cumulative share steps through them by id.
    """
    totals = settle(
        finance.groupBy("customer_id").agg(F.sum("total_revenue").cast("decimal(22,2)").alias("total_revenue")),
        "customer-totals")
    company = totals.agg(F.sum("total_revenue").cast("decimal(22,2)")).scalar()
    ranked = rank_and_accumulate(totals, "total_revenue", "customer_id", "revenue_rank", "running_revenue")

    def percent(value: str) -> Column:
        return F.round(F.col(value).cast("decimal(22,2)") * 100 / F.nullif(company, F.lit(0)), 1).cast("decimal(10,1)")

    described = customers.join(industries, "industry_id", "left").select(
        "customer_id", "customer_name", "customer_type", "contract_tier", "industry_name")
    return ranked.join(described, "customer_id", "left").select(
        "customer_id", "customer_name", "customer_type", "contract_tier", "industry_name", "revenue_rank",
        "total_revenue", percent("total_revenue").alias("pct_of_total_revenue"),
        percent("running_revenue").alias("cumulative_pct_of_total_revenue"))


def top_n_share(concentration: DataFrame, n: int) -> DataFrame:
    """The customers ranked ``n`` or better: the last row answers what share the top n hold."""
    return concentration.filter(F.col("revenue_rank") <= n)


def finance_rollup(finance: DataFrame) -> DataFrame:
    """Company revenue and margin at month, quarter, year and overall level in one pass."""
    sums = ["total_revenue", "equipment_sales_margin", "total_output_tax_allocated"]
    # months first: the rollup then multiplies a few rows per month, not every customer-month
    months = finance.groupBy(
        F.col("period_year").alias("year"), F.col("period_quarter").alias("quarter"), F.month("period_month").alias("month")
    ).agg(*[F.sum(c).alias(c) for c in sums], F.count("*").alias("customer_months"))
    return months.rollup("year", "quarter", "month").agg(
        *[F.sum(c).cast("decimal(24,2)").alias(c) for c in sums],
        F.sum("customer_months").alias("customer_months"), F.grouping_id().cast("int").alias("level"))


def rental_billing(contracts: DataFrame, as_of: date) -> DataFrame:
    """Bill each contract for its elapsed 30-day months, up to its end or the as-of date."""
    until = F.coalesce("end_date", F.lit(as_of))
    months = elapsed_months(F.col("start_date"), until)
    per_month = F.when(F.col("rate_type") == "Daily", F.col("rate") * C.RENTAL_DAYS_PER_MONTH).otherwise(F.col("rate"))
    return (
        contracts.withColumn("elapsed_months", months)
        .withColumn("total_billed", F.round(per_month * F.col("elapsed_months"), 2).cast(MONEY))
    )
