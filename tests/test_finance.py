from __future__ import annotations

from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from fleetworks.plans import finance
from tests.conftest import day, tuples

REVENUE = "customer_id long, period_month date, revenue_stream string, revenue decimal(20,2)"
FILING = ("customer_id long, period_start date, period_end date, vat_amount decimal(18,2), nhil_amount decimal(18,2),"
          " getfund_amount decimal(18,2), withholding_tax_amount decimal(18,2), filing_status string")
MONTHS = [day("2024-01-01"), day("2024-02-01"), day("2024-03-01")]


def filing(amount, customer=1, start="2024-01-01", end="2024-03-31"):
    a = D(str(amount))
    return (customer, day(start), day(end), a, a, a, a, "Filed")


def spread(frame, amount, monthly):
    revenue = frame(REVENUE, [(1, m, "Rental", D(str(r))) for m, r in zip(MONTHS, monthly, strict=True) if r is not None])
    return [r["vat_amount_allocated"] for r in finance.allocate_period_to_month(
        frame(FILING, [filing(amount)]), revenue).orderBy("period_month").collect()]


def test_quarter_without_revenue_splits_evenly(frame):
    allocated = finance.allocate_period_to_month(frame(FILING, [filing(300)]), frame(REVENUE, [])).collect()
    assert [r["vat_amount_allocated"] for r in allocated] == [D("100.00")] * 3
    assert all(abs(float(r["revenue_share_of_quarter"]) - 1 / 3) < 1e-9 for r in allocated)


def test_leftover_cent_is_kept_out(frame):
    assert spread(frame, 100, [1, 1, 1]) == [D("33.33")] * 3


def test_uneven_quarter(frame):
    assert spread(frame, 100, [8, None, 2]) == [D("80.00"), D("0.00"), D("20.00")]


def test_half_cents_round_away_from_zero(frame):
    # 0.01 * 1/2 is exactly half a cent
    assert spread(frame, "0.01", [1, 1, None]) == [D("0.01"), D("0.01"), D("0.00")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(amount=st.integers(0, 10**9), parts=st.lists(st.integers(0, 10**9), min_size=3, max_size=3))
def test_allocation_is_exact_and_reconciles(frame, amount, parts):
    money = [D(p) / 100 for p in parts]
    got = spread(frame, D(amount) / 100, money)
    total = sum(parts)
    shares = parts if total else [1, 1, 1]
    whole = total or 3
    assert got == [D((2 * amount * p + whole) // (2 * whole)) / 100 for p in shares]
    assert abs(sum(got) - D(amount) / 100) <= D("0.015")


def test_reconciliation_flags_a_bad_allocation(frame):
    filings = frame(FILING, [filing(100), filing(50, customer=2)])
    revenue = frame(REVENUE, [(1, MONTHS[0], "Rental", D(5)), (2, MONTHS[1], "Rental", D(5))])
    allocated = finance.allocate_period_to_month(filings, revenue)
    ok = finance.reconcile_allocation(filings, allocated)
    assert {r["reconciles"] for r in ok.collect()} == {True}
    broken = allocated.filter("customer_id = 1")
    assert tuples(finance.reconcile_allocation(filings, broken), "customer_id", "reconciles") == [(1, True), (2, False)]


def _finance(frame, revenue, filings, customers=None):
    revenue = frame(REVENUE, revenue)
    allocated = finance.allocate_period_to_month(frame(FILING, filings), revenue)
    margin = frame("customer_id long, period_month date, equipment_sales_cost decimal(20,2),"
                   " equipment_sales_margin decimal(20,2)", [(1, MONTHS[0], D(60), D(40))])
    people = frame("customer_id long, customer_name string, customer_type string, contract_tier string,"
                   " industry_id int, region string", customers or [(1, "A", "t", "Gold", 1, "r"), (2, "B", "t", "Gold", 9, "r")])
    industries = frame("industry_id int, industry_name string", [(1, "Mining")])
    return finance.finance_monthly(revenue, allocated, margin, people, industries)


def test_months_with_only_one_side_survive(frame):
    rows = {(r["customer_id"], r["period_month"]): r for r in _finance(
        frame, [(1, MONTHS[0], "Equipment Sales", D(100)), (2, day("2024-05-01"), "Service", D(7))],
        [filing(300, customer=1)]).collect()}
    sold = rows[1, MONTHS[0]]
    assert sold["equipment_sales_margin_pct"] == D("40.0") and sold["vat_amount_allocated"] == D("300.00")
    filed_only = rows[1, MONTHS[1]]
    assert filed_only["total_revenue"] == 0 and filed_only["vat_amount_allocated"] == 0
    assert filed_only["equipment_sales_margin_pct"] is None
    earned_only = rows[2, day("2024-05-01")]
    assert earned_only["vat_amount_allocated"] is None and earned_only["service_revenue"] == 7
    assert earned_only["industry_name"] is None and len(rows) == 4


def test_service_counts_only_completed_but_tax_counts_all(frame):
    sales = frame("customer_id long, sale_date date, sale_price decimal(14,2), cost_basis decimal(14,2)", [
        (1, day("2024-01-15"), D(1000), D(700))])
    rentals = frame("customer_id long, start_date date, total_billed decimal(14,2)", [(1, day("2024-02-03"), D(200))])
    orders = frame("customer_id long, scheduled_date date, total_cost decimal(12,2), status string", [
        (1, day("2024-02-10"), D(30), "Completed"), (1, day("2024-02-11"), D(70), "Scheduled")])
    monthly = finance.monthly_lines(finance.revenue_lines(sales, rentals, orders))
    assert tuples(finance.revenue_by_stream_month(monthly), "revenue_stream", "revenue") == [
        ("Equipment Sales", D("1000.00")), ("Rental", D("200.00")), ("Service", D("30.00"))]
    tax = finance.quarterly_tax_filings(monthly, day("2024-04-01"), overdue_rate=0.0).collect()
    assert len(tax) == 1
    assert tax[0]["vat_amount"] == D("195.00") and tax[0]["nhil_amount"] == D("32.50")
    assert tax[0]["withholding_tax_amount"] == D("50.00")  # 30 + 15 + 5
    assert tax[0]["filing_status"] == "Filed" and tax[0]["period_end"] == day("2024-03-31")
    pending = finance.quarterly_tax_filings(monthly, day("2024-03-31")).first()
    assert pending["filing_status"] == "Pending"


def test_sums_of_money_are_exact_at_any_size_and_held_in_longs(frame):
    most = D("9999999999999999.99")
    lines = frame("customer_id long, event_date date, revenue_stream string, amount decimal(18,2), cost decimal(18,2), status string", [
        *[(1, day("2024-01-15"), "Service", most, -most, "Completed")] * 12, (1, day("2024-01-16"), "Service", D("0.01"), None, "Completed"),
        (2, day("2024-01-15"), "Rental", D("-12345678901.23"), None, None), (2, day("2024-01-15"), "Rental", D("0.29"), None, None),
        (2, day("2024-03-15"), "Equipment Sales", D("99999999999.99"), D("1.00"), None), (3, None, None, None, None, None)])
    monthly = finance.monthly_lines(lines)
    assert tuples(monthly, "customer_id", "amount", "cost") == [
        (1, most * 12 + D("0.01"), -most * 12), (2, D("-12345678900.94"), None), (2, D("99999999999.99"), D("1.00")), (3, None, None)]
    filings = finance.quarterly_tax_filings(monthly.filter("customer_id > 1"), day("2024-12-31"))
    assert tuples(filings, "customer_id", "vat_amount") == [(2, D("13148148164.86"))]
    # whole cents are summed for every row; decimals only come back once a group
    plan = filings._jdf.queryExecution().sparkPlan().toString()
    sums = [line for line in plan.splitlines() if "HashAggregate(" in line]
    assert len(sums) == 4 and all("sum(" in line and "sum(amount" not in line and "as bigint)" in line for line in sums)


def _concentration(frame, revenue):
    money = frame("customer_id long, total_revenue decimal(20,2)", [(c, D(r)) for c, r in revenue])
    people = frame("customer_id long, customer_name string, customer_type string, contract_tier string, industry_id int",
                   [(c, str(c), "t", "Gold", 1) for c, _ in revenue])
    return finance.customer_concentration(money, people, frame("industry_id int, industry_name string", [(1, "Mining")]))


def test_tied_customers_share_a_rank(frame):
    got = tuples(_concentration(frame, [(1, 50), (2, 20), (3, 20), (4, 10)]),
                 "customer_id", "revenue_rank", "pct_of_total_revenue", "cumulative_pct_of_total_revenue")
    assert got == [(1, 1, D("50.0"), D("50.0")), (2, 2, D("20.0"), D("70.0")), (3, 2, D("20.0"), D("90.0")),
                   (4, 4, D("10.0"), D("100.0"))]


def test_no_revenue_gives_null_shares(frame):
    rows = _concentration(frame, [(1, 0), (2, 0)]).collect()
    assert {r["pct_of_total_revenue"] for r in rows} == {None} and {r["revenue_rank"] for r in rows} == {1}
    assert _concentration(frame, []).count() == 0


def test_rental_billing(frame):
    contracts = frame("start_date date, end_date date, rate_type string, rate decimal(12,2)", [
        (day("2024-01-01"), day("2024-03-31"), "Monthly", D(100)),
        (day("2024-01-01"), day("2024-01-05"), "Daily", D(10)),
        (day("2024-01-01"), None, "Monthly", D(100))])
    got = tuples(finance.rental_billing(contracts, day("2024-07-01")), "elapsed_months", "total_billed")
    assert got == [(1, D("260.00")), (3, D("300.00")), (6, D("600.00"))]


MONTHLY = "customer_id long, period_month date, revenue_stream string, status string, amount decimal(20,2), cost decimal(20,2)"


def test_rows_placed_by_customer_do_not_move_again(frame):
    monthly = finance.by_customer(frame(MONTHLY, [(1, MONTHS[0], "Rental", None, D(5), None)]))
    filings = finance.quarterly_tax_filings(monthly, day("2024-12-31"))
    allocated = finance.allocate_period_to_month(filings, finance.revenue_rows(monthly))
    assert "ENSURE_REQUIREMENTS" not in allocated._jdf.queryExecution().executedPlan().toString()
    people = frame("customer_id long, customer_name string, customer_type string, contract_tier string, industry_id int,"
                   " region string", [(1, "A", "t", "Gold", 1, "r")])
    joined = finance.finance_monthly(finance.revenue_rows(monthly), allocated, finance.sales_margin_by_month(monthly), people,
                                     frame("industry_id int, industry_name string", [(1, "Mining")]))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "ENSURE_REQUIREMENTS" in line and "period" in line]
    assert not moved and [r["total_revenue"] for r in joined.orderBy("period_month").collect()] == [5, 0, 0]


def test_partitions_by_customer_grow_with_the_rows(frame):
    monthly = frame(MONTHLY, [(i, MONTHS[0], "Rental", None, D(5), None) for i in range(20)])
    assert finance.by_customer(monthly, rows_a_task=2).rdd.getNumPartitions() == 10


def test_null_keys_meet_nothing_and_repeated_filings_stay(frame):
    revenue = frame(REVENUE, [(None, MONTHS[0], "Rental", D(9)), (1, MONTHS[0], "Rental", D(5))])
    allocated = finance.allocate_period_to_month(
        frame(FILING, [filing(300, customer=None), filing(300, customer=1), filing(300, customer=1)]), revenue)
    got = tuples(allocated.filter(F.col("period_month") == MONTHS[0]), "customer_id", "vat_amount_allocated")
    # nobody's filing finds no revenue and splits evenly; filings that repeat share their quarter's revenue
    assert got == [(1, D("150.00")), (1, D("150.00")), (None, D("100.00"))]
