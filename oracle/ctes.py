"""Shared subqueries. A query names the ones it needs; those they need in turn come along."""

from __future__ import annotations

import re


def pick(column: str, table: dict, default: str | None = None) -> str:
    """A CASE for a literal map."""
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    tail = f" ELSE {text(default)}" if default is not None else ""
    return f"CASE {column} {arms}{tail} END"


def half_even(numerator: str, denominator: int) -> str:
    """Whole quotient of non-negative integers, halves going to the even neighbour."""
    n = f"CAST({numerator} AS HUGEINT)"
    q, r = f"({n} // {denominator})", f"({n} % {denominator})"
    up = f"(2 * {r} > {denominator} OR (2 * {r} = {denominator} AND {q} % 2 = 1))"
    return f"({q} + CASE WHEN {up} THEN 1 ELSE 0 END)"


def mix(key: str, salt: int) -> str:
    """The 24-bit draw of an integer key."""
    return f"((((({key})::BIGINT + {salt * 7919}) % 2147483648) * 2654435761 % 4294967296) >> 8)"


def fine(expr: str, digits: int, guard: int = 8) -> str:
    """Round half away from zero, clearing the last bits of floating-point noise first."""
    return f"ROUND(CAST({expr} AS DECIMAL(38,{guard})), {digits})"


TIER = pick("c_mktsegment", {"MACHINERY": "Platinum", "AUTOMOBILE": "Gold", "BUILDING": "Silver"}, "Standard")
LEAD = {1: 14, 2: 11, 3: 19, 4: 10, 5: 7, 6: 15, 7: 32, 8: 27, 9: 24, 10: 20, 11: 11, 12: 8}

CTES: dict[str, str] = {}

CTES["places"] = "SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"

CTES["clients"] = f"""
SELECT c_custkey AS customer_id, c_name AS customer_name,
  {pick("c_mktsegment", {"MACHINERY": "Owner-Operator", "AUTOMOBILE": "Contract Miner",
                         "BUILDING": "Construction Contractor", "FURNITURE": "Quarry Operator",
                         "HOUSEHOLD": "Logistics/Energy"})} AS customer_type,
  {pick("c_mktsegment", {"MACHINERY": 1, "BUILDING": 2, "AUTOMOBILE": 3, "HOUSEHOLD": 4, "FURNITURE": 5})} AS industry_id,
  r_name AS region, {TIER} AS contract_tier
FROM customer LEFT JOIN places ON c_nationkey = n_nationkey"""

CTES["industries"] = """
SELECT * FROM (VALUES (1, 'Mining'), (2, 'Construction'), (3, 'Oil & Gas'), (4, 'Energy/Power'), (5, 'Quarrying'))
  AS v(industry_id, industry_name)"""

CTES["machines"] = """
SELECT c_custkey AS equipment_id, c_nationkey AS model_id, printf('MG%02d%05d', c_nationkey, c_custkey) AS serial_number,
  c_custkey AS customer_id, CAST(DATE '2023-12-15' + CAST(c_custkey % 40 AS INTEGER) AS DATE) AS install_date,
  CASE WHEN c_custkey % 7 = 0 THEN 'Rented' ELSE 'Owned' END AS ownership_type,
  CASE c_custkey % 10 WHEN 9 THEN 'Decommissioned' WHEN 8 THEN 'Idle' ELSE 'Active' END AS status
FROM customer"""

CTES["kinds"] = """
SELECT n_nationkey AS model_id, n_name AS model_name, r_name AS category_name,
  CASE r_regionkey % 3 WHEN 0 THEN 'Mining' WHEN 1 THEN 'Construction' ELSE 'Both' END AS primary_application
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["units"] = """
SELECT * FROM (VALUES (1, 'Hydraulic Pump', 'Hydraulics'), (2, 'Fuel Injector', 'Engine'),
  (12, 'ECM/Sensor Module', 'Electrical')) AS v(component_id, component_name, system_category)"""

CTES["bridge"] = """
SELECT * FROM (VALUES ('error', 1, 0.900), ('error', 2, 0.600), ('purchase', 2, 0.800), ('click', 1, 0.500),
  ('view', 12, 0.150), ('view', 2, 0.100), ('signup', 12, 0.700)) AS v(fault_code, component_id, weight)"""

CTES["crews"] = """
SELECT s_suppkey AS technician_id, r_name AS branch FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey"""

CTES["wares"] = """
SELECT p_partkey AS part_id, 'P-' || p_partkey AS part_number, p_name AS part_name, p_type AS part_category,
  CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost, CAST(p_partkey % 33 + 3 AS INTEGER) AS lead_time_days
FROM part"""

# revenue

CTES["lines"] = """
SELECT o_custkey AS customer_id, l_shipdate::DATE AS event_date,
  CASE l_returnflag WHEN 'A' THEN 'Equipment Sales' WHEN 'N' THEN 'Rental' WHEN 'R' THEN 'Service' END AS revenue_stream,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN l_returnflag = 'A' THEN ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.8, 2) END AS cost,
  l_linestatus = 'F' AS finished
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["revenue"] = """
SELECT customer_id, date_trunc('month', event_date)::DATE AS period_month, revenue_stream,
  SUM(amount) AS revenue, SUM(cost) AS cost
FROM lines WHERE revenue_stream <> 'Service' OR finished GROUP BY ALL"""

CTES["filed"] = """
SELECT customer_id, date_trunc('quarter', event_date)::DATE AS period_start,
  CAST(COALESCE(SUM(amount) FILTER (WHERE revenue_stream = 'Equipment Sales'), 0) * 100 AS HUGEINT) AS goods,
  CAST(COALESCE(SUM(amount) FILTER (WHERE revenue_stream = 'Rental'), 0) * 100 AS HUGEINT) AS services,
  CAST(COALESCE(SUM(amount) FILTER (WHERE revenue_stream = 'Service'), 0) * 100 AS HUGEINT) AS works
FROM lines GROUP BY ALL"""

_base = "(goods + services + works)"
_quarter_key = "customer_id * 1000 + year(period_start) * 4 + quarter(period_start)"
CTES["filings"] = f"""
SELECT customer_id, period_start, CAST(period_start + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period_end,
  {half_even(f"{_base} * 150", 1000)} / 100.0 AS vat_amount,
  {half_even(f"{_base} * 25", 1000)} / 100.0 AS nhil_amount,
  {half_even(f"{_base} * 25", 1000)} / 100.0 AS getfund_amount,
  {half_even("goods * 30 + services * 75 + works * 50", 1000)} / 100.0 AS withholding_tax_amount,
  CASE WHEN CAST(period_start + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) >= DATE '2001-06-30' THEN 'Pending'
       WHEN {mix(_quarter_key, 3)} < 1006633 THEN 'Overdue' ELSE 'Filed' END AS filing_status
FROM filed WHERE {_base} > 0"""

CTES["spread"] = """
SELECT f.*, CAST(f.period_start + INTERVAL (m.i) MONTH AS DATE) AS period_month
FROM filings f CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) m"""

CTES["weighed"] = """
SELECT s.*, COALESCE(t.revenue, 0)::DOUBLE AS month_revenue,
  SUM(COALESCE(t.revenue, 0)) OVER (PARTITION BY s.customer_id, s.period_start)::DOUBLE AS quarter_revenue,
  CAST(COALESCE(t.revenue, 0) * 100 AS HUGEINT) AS part,
  CAST(SUM(COALESCE(t.revenue, 0)) OVER (PARTITION BY s.customer_id, s.period_start) * 100 AS HUGEINT) AS whole
FROM spread s LEFT JOIN (SELECT customer_id, period_month, SUM(revenue) AS revenue FROM revenue GROUP BY ALL) t
  ON t.customer_id = s.customer_id AND t.period_month = s.period_month"""


def _allocated(amount: str) -> str:
    a = f"CAST(ROUND({amount} * 100) AS HUGEINT)"
    exact = f"CASE WHEN whole > 0 THEN (2 * {a} * part + whole) // (2 * whole) ELSE (2 * {a} + 3) // 6 END"
    return f"CAST(({exact}) / 100.0 AS DECIMAL(18,2))"


CTES["allocated"] = f"""
SELECT customer_id, period_month, period_start AS quarter_start, period_end AS quarter_end, filing_status,
  CASE WHEN quarter_revenue > 0 THEN month_revenue / quarter_revenue ELSE 1.0 / 3 END AS revenue_share_of_quarter,
  {_allocated("vat_amount")} AS vat_amount_allocated, {_allocated("nhil_amount")} AS nhil_amount_allocated,
  {_allocated("getfund_amount")} AS getfund_amount_allocated,
  {_allocated("withholding_tax_amount")} AS withholding_tax_allocated
FROM weighed"""

CTES["earned"] = """
SELECT customer_id, period_month,
  COALESCE(SUM(revenue) FILTER (WHERE revenue_stream = 'Equipment Sales'), 0) AS sold,
  COALESCE(SUM(revenue) FILTER (WHERE revenue_stream = 'Rental'), 0) AS rented,
  COALESCE(SUM(revenue) FILTER (WHERE revenue_stream = 'Service'), 0) AS served,
  SUM(revenue) AS total, COALESCE(SUM(cost), 0) AS cost
FROM revenue GROUP BY ALL"""

CTES["finance"] = f"""
SELECT k.customer_id, c.customer_name, c.customer_type, c.contract_tier, c.industry_id, i.industry_name, c.region,
  k.period_month, quarter(k.period_month) AS period_quarter, year(k.period_month) AS period_year,
  COALESCE(e.sold, 0) AS equipment_sales_revenue, COALESCE(e.rented, 0) AS rental_revenue,
  COALESCE(e.served, 0) AS service_revenue, COALESCE(e.total, 0) AS total_revenue,
  COALESCE(e.cost, 0) AS equipment_sales_cost, COALESCE(CASE WHEN e.sold > 0 THEN e.sold - e.cost END, 0) AS equipment_sales_margin,
  CASE WHEN e.sold > 0 THEN {fine("100.0 * (e.sold - e.cost)::DOUBLE / e.sold::DOUBLE", 1)} END AS equipment_sales_margin_pct,
  a.quarter_start AS filing_quarter_start, a.quarter_end AS filing_quarter_end, a.filing_status,
  a.vat_amount_allocated, a.nhil_amount_allocated, a.getfund_amount_allocated,
  a.vat_amount_allocated + a.nhil_amount_allocated + a.getfund_amount_allocated AS total_output_tax_allocated,
  a.withholding_tax_allocated
FROM (SELECT customer_id, period_month FROM earned UNION SELECT customer_id, period_month FROM allocated) k
LEFT JOIN earned e ON e.customer_id = k.customer_id AND e.period_month = k.period_month
LEFT JOIN allocated a ON a.customer_id = k.customer_id AND a.period_month = k.period_month
LEFT JOIN clients c ON c.customer_id = k.customer_id
LEFT JOIN industries i ON i.industry_id = c.industry_id"""

CTES["standing"] = f"""
SELECT t.customer_id, c.customer_name, c.customer_type, c.contract_tier, i.industry_name,
  RANK() OVER (ORDER BY t.total DESC) AS revenue_rank, t.total AS total_revenue,
  {fine("100.0 * t.total::DOUBLE / NULLIF(SUM(t.total) OVER (), 0)::DOUBLE", 1)} AS pct_of_total_revenue,
  {fine("100.0 * (SUM(t.total) OVER (ORDER BY t.total DESC, t.customer_id ROWS UNBOUNDED PRECEDING))::DOUBLE"
        " / NULLIF(SUM(t.total) OVER (), 0)::DOUBLE", 1)} AS cumulative_pct_of_total_revenue
FROM (SELECT customer_id, SUM(total_revenue) AS total FROM finance GROUP BY customer_id) t
LEFT JOIN clients c ON c.customer_id = t.customer_id LEFT JOIN industries i ON i.industry_id = c.industry_id"""

CTES["contracts"] = """
SELECT l_orderkey AS rental_id, l_linenumber AS line_number, l_shipdate::DATE AS start_date,
  CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber % 3 = 0)
       THEN CAST(l_shipdate::DATE + CAST(l_quantity * 7 AS INTEGER) AS DATE) END AS end_date,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Daily' ELSE 'Monthly' END AS rate_type,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS rate
FROM lineitem WHERE l_returnflag = 'N'"""

# work orders

CTES["jobs"] = f"""
SELECT o_orderkey AS work_order_id, o_custkey AS equipment_id, o_custkey AS customer_id,
  {pick("o_orderpriority", {"1-URGENT": "Corrective", "2-HIGH": "Predictive", "3-MEDIUM": "Inspection"}, "Preventive")}
    AS maintenance_type,
  {pick("o_orderpriority", {"1-URGENT": "Critical", "2-HIGH": "High"}, "Routine")} AS priority,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 2 = 0 THEN o_orderkey END AS source_signal_id,
  o_orderdate::DATE AS scheduled_date, o_orderdate + INTERVAL 8 HOUR AS actual_start,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + INTERVAL 8 HOUR + to_hours(CAST((o_orderkey * 7) % 60 AS INTEGER)) END
    AS actual_completion,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST((o_orderkey * 7) % 60 AS DECIMAL(6,1)) END AS downtime_hours,
  CAST((o_orderkey % 40) / 4.0 AS DECIMAL(6,1)) AS labor_hours,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost,
  {pick("o_orderstatus", {"F": "Completed", "O": "Scheduled", "P": "In Progress"})} AS status
FROM orders"""

CTES["sales"] = """
SELECT l_orderkey * 10 + l_linenumber AS sale_id, o_custkey AS equipment_id, o_custkey AS customer_id,
  l_shipdate::DATE AS sale_date, CAST(l_extendedprice AS DECIMAL(14,2)) AS sale_price,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * 0.8, 2) AS DECIMAL(14,2)) AS cost_basis
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'"""

CTES["rentals"] = """
SELECT c.rental_id * 10 + c.line_number AS rental_id, o_custkey AS equipment_id, o_custkey AS customer_id, c.start_date,
  c.end_date, c.rate_type, c.rate, c.rate AS total_billed
FROM contracts c JOIN orders ON c.rental_id = o_orderkey"""

CTES["assigned"] = "SELECT l_orderkey AS work_order_id, MIN(l_suppkey) AS technician_id FROM lineitem GROUP BY 1"

CTES["used"] = """
SELECT l_orderkey AS work_order_id, l_partkey AS part_id, SUM(CAST(l_quantity AS BIGINT)) AS qty_used
FROM lineitem GROUP BY ALL"""

CTES["consumed"] = """
SELECT u.part_id, j.customer_id, j.scheduled_date, u.qty_used
FROM used u JOIN jobs j ON u.work_order_id = j.work_order_id"""

CTES["branches_used"] = f"""
SELECT part_id, branch, SUM(used) AS used FROM (
  SELECT u.part_id, c.region AS branch, u.qty_used AS used FROM consumed u LEFT JOIN clients c USING (customer_id))
GROUP BY ALL"""

CTES["stocked"] = """
SELECT part_id, branch, DATE '2001-08-01' AS snapshot_date, unit_cost_usd, lead_time_days, share, daily,
  GREATEST(1.0, round_even(daily * 25.0, 0)) AS stock,
  GREATEST(1.0, round_even(daily * lead_time_days * 1.5, 0)) AS reorder
FROM (
  SELECT w.part_id, r.r_name AS branch, w.unit_cost AS unit_cost_usd, w.lead_time_days,
    (COALESCE(b.used, 0)::DOUBLE + 1) / SUM(COALESCE(b.used, 0)::DOUBLE + 1) OVER (PARTITION BY w.part_id) AS share,
    GREATEST(SUM(COALESCE(b.used, 0)::DOUBLE) OVER (PARTITION BY w.part_id)
             / (SELECT GREATEST(1, MAX(scheduled_date) - MIN(scheduled_date)) FROM jobs), 0.01) AS daily
  FROM wares w CROSS JOIN region r LEFT JOIN branches_used b ON b.part_id = w.part_id AND b.branch = r.r_name)"""

CTES["inventory"] = f"""
SELECT part_id, branch, snapshot_date, CAST(GREATEST(0.0, round_even(stock * share, 0)) AS INTEGER) AS qty_on_hand,
  {half_even("CAST(unit_cost_usd * 100 AS HUGEINT) * 1140", 100)} / 100.0 AS unit_cost,
  CAST(GREATEST(1.0, round_even(reorder * share, 0)) AS INTEGER) AS reorder_point,
  round_even(GREATEST(0.0, round_even(stock * share, 0)) / daily, 1) AS days_of_supply
FROM stocked"""

# telemetry and signals

CTES["alerts"] = f"""
SELECT user_id AS equipment_id, ts::DATE AS event_date, event_type AS fault_code, value AS reading,
  {pick("event_type", {"error": "Critical", "purchase": "Warning", "click": "Warning"}, "Info")} AS severity
FROM events"""

CTES["daily"] = f"""
SELECT *, SUM(utilization_hours) OVER (PARTITION BY equipment_id ORDER BY date_id) AS engine_hours FROM (
  SELECT equipment_id, event_date AS date_id, CAST(LEAST(24.0, COUNT(*) * 0.5) AS DECIMAL(5,1)) AS utilization_hours,
    COUNT(*) FILTER (WHERE severity = 'Info') AS fault_count_info,
    COUNT(*) FILTER (WHERE severity = 'Warning') AS fault_count_warning,
    COUNT(*) FILTER (WHERE severity = 'Critical') AS fault_count_critical,
    {fine("SUM(CAST(reading AS DECIMAL(12,3)))::DOUBLE / COUNT(reading)", 3)} AS avg_sensor_reading,
    MAX(CAST(reading AS DECIMAL(12,3))) AS max_sensor_reading
  FROM alerts GROUP BY ALL)"""

CTES["days"] = "SELECT DISTINCT event_date AS date_id FROM alerts"
CTES["newest"] = "SELECT MAX(event_date) AS day FROM alerts"

CTES["scored"] = """
SELECT a.equipment_id, b.component_id, a.event_date AS date_id,
  SUM(b.weight * CASE a.severity WHEN 'Critical' THEN 3.0 WHEN 'Warning' THEN 1.5 ELSE 1.0 END) AS score,
  COUNT(*) FILTER (WHERE a.severity = 'Critical') AS criticals, COUNT(*) AS faults
FROM alerts a JOIN bridge b USING (fault_code) GROUP BY ALL"""

CTES["spine"] = """
SELECT m.equipment_id, m.model_id, m.customer_id, m.install_date, u.component_id, d.date_id
FROM machines m CROSS JOIN units u CROSS JOIN days d
WHERE m.status IN ('Active', 'Idle') AND d.date_id >= m.install_date"""

CTES["marks"] = "SELECT DISTINCT equipment_id, event_date AS date_id FROM alerts WHERE fault_code = 'signup'"

CTES["last_marks"] = """
SELECT d.equipment_id, d.date_id, m.date_id AS last_maint_date
FROM (SELECT equipment_id, date_id FROM daily UNION SELECT equipment_id, date_id FROM marks) d
ASOF LEFT JOIN marks m ON d.equipment_id = m.equipment_id AND d.date_id >= m.date_id"""

CTES["failed"] = """
SELECT user_id AS equipment_id, CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 12 END AS component_id,
  ts::DATE AS failure_date
FROM events WHERE event_type = 'error' AND value >= 150"""


def _trailing(value: str, days: int) -> str:
    return (f"SUM({value}) OVER (PARTITION BY equipment_id, component_id ORDER BY date_id"
            f" RANGE BETWEEN INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)")


CTES["rolled"] = f"""
SELECT *, {_trailing("score", 7)} AS score_7, {_trailing("score", 14)} AS score_14, {_trailing("score", 30)} AS score_30,
  {_trailing("criticals", 7)} AS criticals_7, {_trailing("criticals", 14)} AS criticals_14
FROM (
  SELECT s.*, COALESCE(f.score, 0) AS score, COALESCE(f.criticals, 0) AS criticals, COALESCE(f.faults, 0) AS faults
  FROM spine s LEFT JOIN scored f USING (equipment_id, component_id, date_id))"""

CTES["labelled"] = """
SELECT s.equipment_id, s.component_id, s.date_id, CASE WHEN EXISTS (
    SELECT 1 FROM failed f WHERE f.equipment_id = s.equipment_id AND f.component_id = s.component_id
      AND f.failure_date > s.date_id AND f.failure_date <= s.date_id + 21) THEN 1 ELSE 0 END AS label
FROM spine s"""

CTES["codes"] = """
SELECT equipment_id, component_id, string_agg(fault_code, ',' ORDER BY fault_code) AS contributing_fault_codes
FROM (SELECT DISTINCT a.equipment_id, b.component_id, a.fault_code FROM alerts a JOIN bridge b USING (fault_code), newest
      WHERE a.event_date > newest.day - 14)
GROUP BY ALL"""

CTES["signals"] = f"""
SELECT ROW_NUMBER() OVER (ORDER BY equipment_id, component_id) AS signal_id, equipment_id, date_id AS scoring_date,
  component_id AS predicted_component_id, p AS failure_probability, 'risk-v1' AS model_version,
  {pick("component_id", LEAD)} AS recommended_action_window_days, contributing_fault_codes,
  CASE WHEN p >= 0.7 THEN 'Action Recommended' WHEN p >= 0.4 THEN 'Watch' ELSE 'New' END AS signal_status,
  CAST(NULL AS VARCHAR) AS dismiss_reason
FROM (
  SELECT r.equipment_id, r.component_id, r.date_id, c.contributing_fault_codes,
    ROUND(0.02 + (0.98 - 0.02) / (1.0 + exp(-0.12 * (r.score_30::DOUBLE - 38.0))), 4) AS p
  FROM rolled r JOIN newest ON r.date_id = newest.day
  LEFT JOIN codes c ON c.equipment_id = r.equipment_id AND c.component_id = r.component_id)"""

CTES["visits"] = """
SELECT equipment_id, CAST(DATE '2024-01-28' + CAST(work_order_id % 400 AS INTEGER) AS DATE) AS day
FROM jobs WHERE status = 'Scheduled'"""

CTES["triaged"] = """
SELECT * REPLACE (
    CASE WHEN covered THEN 'Duplicate - open work order already scheduled for this machine' ELSE dismiss_reason END
      AS dismiss_reason,
    CASE WHEN covered THEN 'Dismissed'
         WHEN signal_status = 'Watch' AND tier = 'Platinum' AND recommended_action_window_days <= 10
           THEN 'Action Recommended'
         ELSE signal_status END AS signal_status)
FROM (
  SELECT s.*, m.customer_id, m.model_id, c.contract_tier AS tier, s.signal_status <> 'New' AND EXISTS (
    SELECT 1 FROM visits v WHERE v.equipment_id = s.equipment_id AND v.day >= s.scoring_date
      AND v.day <= s.scoring_date + s.recommended_action_window_days) AS covered
  FROM signals s LEFT JOIN machines m ON m.equipment_id = s.equipment_id
  LEFT JOIN clients c ON c.customer_id = m.customer_id)"""

CTES["candidates"] = """
SELECT t.*, k.part_category, k.qty, k.is_primary, f.part_id FROM triaged t
LEFT JOIN (VALUES (1, 'ECONOMY', 1, true), (1, 'SMALL', 2, false), (2, 'MEDIUM', 1, true), (2, 'UNLISTED', 1, false),
  (12, 'LARGE', 1, true)) AS k(component_id, part_category, qty, is_primary) ON k.component_id = t.predicted_component_id
LEFT JOIN (SELECT n_nationkey AS model_id, p_type AS part_category, MIN(p_partkey) AS part_id
           FROM part JOIN nation ON (p_partkey + n_nationkey) % 3 = 0 GROUP BY ALL) f
  ON f.model_id = t.model_id AND f.part_category = k.part_category
WHERE t.signal_status = 'Action Recommended'"""

CTES["demand"] = """
SELECT ROW_NUMBER() OVER (ORDER BY signal_id, is_primary DESC, part_category) AS forecast_id, signal_id, equipment_id, part_id,
  qty AS expected_qty, is_primary, CAST(scoring_date + recommended_action_window_days AS DATE) AS needed_by_date,
  'Predictive Signal' AS demand_source
FROM candidates WHERE part_id IS NOT NULL"""

CTES["gaps"] = """
SELECT ROW_NUMBER() OVER (ORDER BY signal_id, component_id, model_id) AS gap_id, signal_id, component_id, model_id,
  false AS resolved
FROM (SELECT predicted_component_id AS component_id, model_id, MIN(signal_id) AS signal_id
      FROM candidates WHERE part_id IS NULL GROUP BY ALL)"""

CTES["gap_details"] = """
SELECT g.gap_id, g.signal_id, s.scoring_date, s.equipment_id, m.serial_number, m.customer_id, c.customer_name,
  i.industry_name, g.component_id, u.component_name, u.system_category, g.model_id, k.model_name, k.category_name, g.resolved
FROM gaps g LEFT JOIN signals s ON s.signal_id = g.signal_id LEFT JOIN machines m ON m.equipment_id = s.equipment_id
LEFT JOIN clients c ON c.customer_id = m.customer_id LEFT JOIN industries i ON i.industry_id = c.industry_id
LEFT JOIN units u ON u.component_id = g.component_id LEFT JOIN kinds k ON k.model_id = g.model_id"""

CTES["reviewed"] = f"""
SELECT * REPLACE (
    CASE WHEN signal_status <> 'Action Recommended' THEN dismiss_reason
         WHEN {mix("signal_id", 0)} < 2516582 THEN CASE {mix("signal_id", 1)} % 3
           WHEN 0 THEN 'Advisor judgment - likely false reading'
           WHEN 1 THEN 'Customer declined proactive service at this time'
           ELSE 'Machine already scheduled for service through another channel' END
         ELSE dismiss_reason END AS dismiss_reason,
    CASE WHEN signal_status <> 'Action Recommended' THEN signal_status
         WHEN {mix("signal_id", 0)} < 2516582 THEN 'Dismissed' ELSE 'Converted' END AS signal_status)
FROM triaged"""

CTES["slots"] = """
SELECT branch, technician_id, ROW_NUMBER() OVER (PARTITION BY branch ORDER BY technician_id) - 1 AS slot,
  COUNT(*) OVER (PARTITION BY branch) AS pool_size,
  ROW_NUMBER() OVER (ORDER BY branch, technician_id) - 1 AS overall_slot, COUNT(*) OVER () AS overall_size
FROM crews"""

_widest = "GREATEST(1, recommended_action_window_days - 2)"
CTES["booked"] = f"""
SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY r.signal_id) AS work_order_id,
  r.equipment_id, r.customer_id,
  COALESCE(mine.technician_id, anyone.technician_id) AS technician_id, 'Predictive' AS maintenance_type,
  CASE WHEN r.failure_probability >= 0.85 THEN 'Critical' ELSE 'High' END AS priority,
  r.signal_id AS source_signal_id,
  CAST(r.scoring_date + CAST(1 + {mix("r.signal_id", 3)} % CASE WHEN COALESCE(r.tier, 'Standard') = 'Platinum'
     THEN GREATEST(1, {_widest} // 2) ELSE {_widest} END AS INTEGER) AS DATE) AS scheduled_date,
  {pick("COALESCE(r.tier, 'Standard')", {"Platinum": 6, "Gold": 12, "Silver": 24, "Standard": 48})} AS sla_target_hours,
  false AS warranty_flag, 'Scheduled' AS status, false AS follow_up_required
FROM (SELECT v.*, COALESCE(c.region, 'Accra') AS branch FROM reviewed v LEFT JOIN clients c ON c.customer_id = v.customer_id
      WHERE v.signal_status = 'Converted') r
LEFT JOIN slots mine ON mine.branch = r.branch AND mine.slot = {mix("r.signal_id", 2)} % mine.pool_size
LEFT JOIN slots anyone ON r.branch NOT IN (SELECT branch FROM crews WHERE branch IS NOT NULL)
  AND anyone.overall_slot = {mix("r.signal_id", 2)} % anyone.overall_size"""

CTES["enriched"] = """
SELECT r.signal_id, r.equipment_id, m.serial_number, m.customer_id, c.customer_name, c.contract_tier, k.model_name,
  k.category_name, r.scoring_date, r.predicted_component_id, u.component_name, u.system_category, r.failure_probability,
  r.model_version, r.recommended_action_window_days, r.signal_status, r.dismiss_reason,
  b.work_order_id AS resulting_work_order_id, b.scheduled_date AS resulting_scheduled_date
FROM reviewed r LEFT JOIN machines m ON m.equipment_id = r.equipment_id
LEFT JOIN clients c ON c.customer_id = m.customer_id LEFT JOIN kinds k ON k.model_id = m.model_id
LEFT JOIN units u ON u.component_id = r.predicted_component_id LEFT JOIN booked b ON b.source_signal_id = r.signal_id"""

CTES["outcomes"] = """
SELECT signal_id, CASE WHEN lead_days <= lead_limit THEN 'Confirmed Failure'
    WHEN scored_on + lead_limit <= last_seen THEN 'False Positive' END AS actual_outcome,
  CASE WHEN lead_days <= lead_limit THEN lead_days END AS lead_time_delivered_days,
  (SELECT MIN(work_order_id) FROM jobs WHERE source_signal_id = signal_id) AS resulting_work_order_id
FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY r.date_id, r.equipment_id, r.component_id) AS signal_id, r.date_id AS scored_on,
    newest.day AS last_seen, CASE r.component_id WHEN 1 THEN 14 WHEN 2 THEN 11 ELSE 8 END AS lead_limit,
    (SELECT MIN(f.failure_date) FROM failed f WHERE f.equipment_id = r.equipment_id AND f.component_id = r.component_id
       AND f.failure_date > r.date_id) - r.date_id AS lead_days
  FROM rolled r CROSS JOIN newest
  WHERE ROUND(0.02 + (0.98 - 0.02) / (1.0 + exp(-0.12 * (r.score_30::DOUBLE - 38.0))), 4) >= 0.4)"""

def _stock_mart(yearly: str) -> str:
    return f"""
SELECT *, CASE WHEN is_dead_stock THEN inventory_value_ghs ELSE 0 END AS dead_stock_value
FROM (
  SELECT n.part_id, w.part_number, w.part_name, w.part_category, n.branch, n.snapshot_date, n.qty_on_hand,
    n.unit_cost AS unit_cost_ghs, CAST(n.qty_on_hand * n.unit_cost AS DECIMAL(24,2)) AS inventory_value_ghs,
    n.reorder_point, n.days_of_supply, n.qty_on_hand < n.reorder_point AS is_below_reorder_point,
    {fine("COALESCE(c.yearly, 0)", 6, 11)} AS annualized_consumption,
    CASE WHEN n.qty_on_hand > 0 THEN {fine("COALESCE(c.yearly, 0) / n.qty_on_hand", 2)} END AS inventory_turnover_ratio,
    c.last_day AS last_consumption_date, n.snapshot_date - c.last_day AS days_since_last_consumption,
    n.qty_on_hand > 0 AND (c.last_day IS NULL OR n.snapshot_date - c.last_day > 180) AS is_dead_stock,
    COALESCE(d.signals, 0) AS predictive_demand_signals, COALESCE(d.qty, 0) AS predictive_demand_qty
  FROM inventory n LEFT JOIN wares w ON w.part_id = n.part_id
  LEFT JOIN (SELECT part_id, MAX(scheduled_date) AS last_day, {yearly} AS yearly
             FROM consumed GROUP BY 1) c ON c.part_id = n.part_id
  LEFT JOIN (SELECT part_id, COUNT(*) AS signals, SUM(expected_qty) AS qty FROM demand GROUP BY 1) d
    ON d.part_id = n.part_id) AS stock"""


_span = "(SELECT MAX(scheduled_date) - MIN(scheduled_date) FROM consumed)"
CTES["stock_mart"] = _stock_mart(f"SUM(qty_used)::DOUBLE * 365 / {_span}")
CTES["stock_mart_whole"] = _stock_mart(f"((SUM(qty_used) // {_span}) * 365)::DOUBLE")

CTES["fleet"] = """
SELECT m.equipment_id, m.serial_number, m.ownership_type, m.status, m.install_date, k.model_name, k.category_name,
  k.primary_application, c.customer_id, c.customer_name, c.customer_type, c.region, t.avg_daily_utilization_hours,
  t.latest_engine_hours, t.total_critical_faults, w.corrective_count, w.avg_mttr_hours, w.total_downtime_hours,
  w.last_service_date, g.mtbf_days, n.total_rental_billed, n.total_actual_usage_hours
FROM machines m LEFT JOIN kinds k ON k.model_id = m.model_id LEFT JOIN clients c ON c.customer_id = m.customer_id
LEFT JOIN (SELECT equipment_id, AVG(utilization_hours) AS avg_daily_utilization_hours, MAX(engine_hours) AS latest_engine_hours,
             SUM(fault_count_critical) AS total_critical_faults FROM daily GROUP BY 1) t ON t.equipment_id = m.equipment_id
LEFT JOIN (SELECT equipment_id, COUNT(*) FILTER (WHERE maintenance_type = 'Corrective') AS corrective_count,
             AVG(downtime_hours) FILTER (WHERE maintenance_type = 'Corrective') AS avg_mttr_hours,
             SUM(downtime_hours) AS total_downtime_hours, MAX(scheduled_date) AS last_service_date
           FROM jobs WHERE status = 'Completed' GROUP BY 1) w ON w.equipment_id = m.equipment_id
LEFT JOIN (SELECT equipment_id, AVG(gap) AS mtbf_days FROM (
             SELECT equipment_id, scheduled_date - LAG(scheduled_date) OVER (PARTITION BY equipment_id ORDER BY scheduled_date) AS gap
             FROM jobs WHERE status = 'Completed' AND maintenance_type = 'Corrective') GROUP BY 1) g
  ON g.equipment_id = m.equipment_id
LEFT JOIN (SELECT o_custkey AS equipment_id, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_rental_billed,
             SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01, 1)) AS total_actual_usage_hours
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N' GROUP BY 1) n
  ON n.equipment_id = m.equipment_id"""


def with_ctes(sql: str) -> str:
    """Prefix a query with every shared subquery it reaches, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + sql
