"""One checking query per report, with the reporting types spelled out.

A column list such as ``customer_id:i revenue:f`` names the output columns and casts them:
i BIGINT, f DOUBLE, d DATE, s VARCHAR, b BOOLEAN.
"""

from __future__ import annotations

from fleetworks.schemas import CONSTRAINTS
from oracle.ctes import fine, half_even, with_ctes

TYPES = {"i": "BIGINT", "f": "DOUBLE", "d": "DATE", "s": "VARCHAR", "b": "BOOLEAN"}

ORACLE: dict[str, str] = {}


def check(name: str, columns: str, sql: str) -> None:
    picked = ", ".join(
        f"CAST({column} AS {TYPES[kind]}) AS {column}" for column, kind in (c.split(":") for c in columns.split()))
    ORACLE[name] = with_ctes(f"SELECT {picked} FROM ({sql}) AS result")


# Finance

check("revenue_by_stream_month", "customer_id:i period_month:d revenue_stream:s revenue:f", "SELECT * FROM revenue")

check("revenue_of_three_tables", "customer_id:i period_month:d revenue_stream:s revenue:f", """
SELECT customer_id, date_trunc('month', day)::DATE AS period_month, revenue_stream, SUM(amount) AS revenue
FROM (SELECT customer_id, sale_date AS day, 'Equipment Sales' AS revenue_stream, sale_price AS amount FROM sales
      UNION ALL SELECT customer_id, start_date, 'Rental', total_billed FROM rentals
      UNION ALL SELECT customer_id, scheduled_date, 'Service', total_cost FROM jobs WHERE status = 'Completed')
GROUP BY ALL""")

check("staged_sales",
      "sale_id:i equipment_id:i customer_id:i sale_date:d sale_price:f cost_basis:f salesperson:s margin:f",
      "SELECT *, NULL AS salesperson, sale_price - cost_basis AS margin FROM sales")

check("staged_rentals",
      "rental_id:i equipment_id:i customer_id:i start_date:d end_date:d rate_type:s rate:f total_billed:f is_ongoing:b",
      "SELECT *, end_date IS NULL AS is_ongoing FROM rentals")

check("staged_orders",
      "work_order_id:i customer_id:i source_signal_id:i scheduled_date:d total_cost:f status:s is_predictive_sourced:b",
      "SELECT *, source_signal_id IS NOT NULL AS is_predictive_sourced FROM jobs")

check("staged_tax_filings",
      "customer_id:i period_start:d period_end:d vat_amount:f nhil_amount:f getfund_amount:f withholding_tax_amount:f"
      " filing_status:s total_output_tax:f", """
SELECT *, CAST(vat_amount AS DECIMAL(18,2)) + CAST(nhil_amount AS DECIMAL(18,2)) + CAST(getfund_amount AS DECIMAL(18,2))
    AS total_output_tax FROM filings""")

check("tax_filings_quarterly",
      "customer_id:i period_start:d period_end:d vat_amount:f nhil_amount:f getfund_amount:f withholding_tax_amount:f"
      " filing_status:s", "SELECT * FROM filings")

check("tax_allocated_to_month",
      "customer_id:i period_month:d quarter_start:d quarter_end:d filing_status:s revenue_share_of_quarter:f"
      " vat_amount_allocated:f nhil_amount_allocated:f getfund_amount_allocated:f withholding_tax_allocated:f",
      "SELECT * REPLACE (ROUND(revenue_share_of_quarter, 6) AS revenue_share_of_quarter) FROM allocated")


def _residual(tax: str, column: str) -> str:
    return f"SUM(a.{column}) - CAST(MAX(f.{tax}_amount) AS DECIMAL(18,2)) AS {tax}_residual"


check("tax_reconciliation",
      "customer_id:i period_start:d vat_residual:f nhil_residual:f getfund_residual:f withholding_tax_residual:f"
      " reconciles:b", f"""
SELECT *, ABS(vat_residual) <= 0.02 AND ABS(nhil_residual) <= 0.02 AND ABS(getfund_residual) <= 0.02
  AND ABS(withholding_tax_residual) <= 0.02 AS reconciles
FROM (SELECT f.customer_id, f.period_start, {_residual("vat", "vat_amount_allocated")},
        {_residual("nhil", "nhil_amount_allocated")}, {_residual("getfund", "getfund_amount_allocated")},
        {_residual("withholding_tax", "withholding_tax_allocated")}
      FROM filings f JOIN allocated a ON a.customer_id = f.customer_id AND a.quarter_start = f.period_start
      GROUP BY f.customer_id, f.period_start) AS r""")

check("finance_monthly",
      "customer_id:i customer_name:s customer_type:s contract_tier:s industry_id:i industry_name:s region:s"
      " period_month:d period_quarter:i period_year:i equipment_sales_revenue:f rental_revenue:f service_revenue:f"
      " total_revenue:f equipment_sales_cost:f equipment_sales_margin:f equipment_sales_margin_pct:f"
      " filing_quarter_start:d filing_quarter_end:d filing_status:s vat_amount_allocated:f nhil_amount_allocated:f"
      " getfund_amount_allocated:f total_output_tax_allocated:f withholding_tax_allocated:f", "SELECT * FROM finance")

_standing = ("customer_id:i customer_name:s customer_type:s contract_tier:s industry_name:s revenue_rank:i"
             " total_revenue:f pct_of_total_revenue:f cumulative_pct_of_total_revenue:f")
check("customer_concentration", _standing, "SELECT * FROM standing")
check("top_n_share", _standing, "SELECT * FROM standing WHERE revenue_rank <= 3")

check("finance_rollup",
      "year:i quarter:i month:i total_revenue:f equipment_sales_margin:f total_output_tax_allocated:f customer_months:i"
      " level:i", """
SELECT y AS year, q AS quarter, m AS month, SUM(total_revenue) AS total_revenue,
  SUM(equipment_sales_margin) AS equipment_sales_margin, SUM(total_output_tax_allocated) AS total_output_tax_allocated,
  COUNT(*) AS customer_months, GROUPING_ID(y, q, m) AS level
FROM (SELECT *, period_year AS y, period_quarter AS q, month(period_month) AS m FROM finance) AS t
GROUP BY ROLLUP (y, q, m)""")

check("rental_billing",
      "rental_id:i line_number:i start_date:d end_date:d rate_type:s rate:f elapsed_months:i total_billed:f", """
SELECT *, rate * elapsed_months * CASE WHEN rate_type = 'Daily' THEN 26 ELSE 1 END AS total_billed
FROM (SELECT *, CAST(GREATEST(1, FLOOR((COALESCE(end_date, DATE '2001-06-30') - start_date) / 30.0)) AS INTEGER) AS elapsed_months
      FROM contracts) AS c""")

# Service and fleet

check("branch_performance",
      "branch:s period_month:d work_order_count:i preventive_count:i corrective_count:i predictive_count:i"
      " inspection_count:i avg_downtime_hours:f sla_measurable_count:i sla_met_count:i active_technicians:i"
      " sla_compliance_pct:f", f"""
SELECT branch, date_trunc('month', scheduled_date)::DATE AS period_month, COUNT(*) AS work_order_count,
  COUNT(*) FILTER (WHERE maintenance_type = 'Preventive') AS preventive_count,
  COUNT(*) FILTER (WHERE maintenance_type = 'Corrective') AS corrective_count,
  COUNT(*) FILTER (WHERE maintenance_type = 'Predictive') AS predictive_count,
  COUNT(*) FILTER (WHERE maintenance_type = 'Inspection') AS inspection_count,
  {fine("SUM(downtime_hours)::DOUBLE / NULLIF(COUNT(downtime_hours), 0)", 2)} AS avg_downtime_hours,
  COUNT(hours) AS sla_measurable_count, COUNT(*) FILTER (WHERE hours <= target) AS sla_met_count,
  COUNT(DISTINCT technician_id) AS active_technicians,
  {fine("100.0 * COUNT(*) FILTER (WHERE hours <= target) / NULLIF(COUNT(hours), 0)", 1)} AS sla_compliance_pct
FROM (SELECT j.*, a.technician_id, t.branch, epoch(j.actual_completion - j.actual_start) / 3600.0 AS hours,
        CASE c.contract_tier WHEN 'Platinum' THEN 6 WHEN 'Gold' THEN 12 WHEN 'Silver' THEN 24 ELSE 48 END AS target
      FROM jobs j LEFT JOIN assigned a ON a.work_order_id = j.work_order_id
      LEFT JOIN crews t ON t.technician_id = a.technician_id LEFT JOIN clients c ON c.customer_id = j.customer_id
      WHERE j.status = 'Completed') AS done
GROUP BY 1, 2""")

check("maintenance_type_ratio", "period_month:d maintenance_type:s is_predictive_sourced:b work_order_count:i", """
SELECT date_trunc('month', scheduled_date)::DATE AS period_month, maintenance_type,
  source_signal_id IS NOT NULL AS is_predictive_sourced, COUNT(*) AS work_order_count
FROM jobs WHERE status = 'Completed' GROUP BY 1, 2, 3""")

check("work_order_costing",
      "work_order_id:i equipment_id:i scheduled_date:d parts_cost:f labour_cost:f total_cost:f warranty_eligible:b", f"""
SELECT j.work_order_id, j.equipment_id, j.scheduled_date, ROUND(COALESCE(p.cost, 0), 2) AS parts_cost,
  j.labor_hours * 180 AS labour_cost,
  {half_even("(COALESCE(p.cost, 0) + j.labor_hours * 180) * 10000", 100)} / 100.0 AS total_cost,
  j.scheduled_date - CAST(DATE '1995-01-01' + CAST(m.equipment_id % 1500 AS INTEGER) AS DATE) <= 730 AS warranty_eligible
FROM jobs j LEFT JOIN machines m ON m.equipment_id = j.equipment_id
LEFT JOIN (SELECT u.work_order_id, CAST(SUM(u.qty_used * w.unit_cost * 11.40) AS DECIMAL(24,4)) AS cost
           FROM used u JOIN wares w ON w.part_id = u.part_id GROUP BY 1) p ON p.work_order_id = j.work_order_id""")

check("corrective_gaps", "equipment_id:i scheduled_date:d n:i days_since_prior_corrective:i", """
SELECT *, scheduled_date - LAG(scheduled_date) OVER (PARTITION BY equipment_id ORDER BY scheduled_date)
  AS days_since_prior_corrective
FROM (SELECT equipment_id, scheduled_date, COUNT(*) AS n FROM jobs
      WHERE maintenance_type = 'Corrective' AND status = 'Completed' GROUP BY 1, 2) AS d""")

check("fleet_operations",
      "equipment_id:i serial_number:s ownership_type:s status:s install_date:d model_name:s category_name:s"
      " primary_application:s customer_id:i customer_name:s customer_type:s region:s avg_daily_utilization_hours:f"
      " latest_engine_hours:f total_critical_faults:i corrective_count:i avg_mttr_hours:f total_downtime_hours:f"
      " last_service_date:d mtbf_days:f total_rental_billed:f total_actual_usage_hours:f", """
SELECT * REPLACE (ROUND(avg_daily_utilization_hours, 6) AS avg_daily_utilization_hours,
  ROUND(avg_mttr_hours, 6) AS avg_mttr_hours, ROUND(mtbf_days, 6) AS mtbf_days) FROM fleet""")

check("ownership_split",
      "ownership_type:s machines:i corrective_orders:i downtime_hours:f rental_billed:f usage_hours:f", """
SELECT ownership_type, COUNT(*) AS machines, SUM(corrective_count) AS corrective_orders,
  SUM(total_downtime_hours) AS downtime_hours, SUM(total_rental_billed) AS rental_billed,
  SUM(total_actual_usage_hours) AS usage_hours
FROM fleet GROUP BY 1""")

check("rental_use",
      "equipment_id:i ownership_type:s total_rental_billed:f total_actual_usage_hours:f billed_per_hour:f", f"""
SELECT equipment_id, ownership_type, total_rental_billed, total_actual_usage_hours,
  {fine("total_rental_billed::DOUBLE / NULLIF(total_actual_usage_hours, 0)::DOUBLE", 2)} AS billed_per_hour
FROM fleet WHERE total_rental_billed IS NOT NULL""")

check("active_windows_daily", "rate_type:s date_id:d active_count:i", """
SELECT rate_type, CAST(day AS DATE) AS date_id, COUNT(*) AS active_count
FROM (SELECT rate_type, unnest(generate_series(start_date::TIMESTAMP, COALESCE(end_date, DATE '2001-06-30')::TIMESTAMP,
        INTERVAL 1 DAY)) AS day FROM contracts) AS d
GROUP BY 1, 2""")

check("orders_during_rentals",
      "equipment_id:i work_order_id:i scheduled_date:d rental_id:i start_date:d end_date:d", """
SELECT j.equipment_id, j.work_order_id, j.scheduled_date, r.rental_id, r.start_date, r.end_date
FROM jobs j JOIN rentals r ON r.equipment_id = j.equipment_id AND j.scheduled_date >= r.start_date
  AND (r.end_date IS NULL OR j.scheduled_date <= r.end_date)""")

# Inventory

check("parts_consumption", "part_id:i customer_id:i scheduled_date:d qty_used:i", "SELECT * FROM consumed")

check("inventory_replenishment",
      "part_id:i branch:s snapshot_date:d qty_on_hand:i unit_cost:f reorder_point:i days_of_supply:f",
      "SELECT * FROM inventory")

check("warehouse_inventory",
      "part_id:i part_number:s part_name:s part_category:s branch:s snapshot_date:d qty_on_hand:i unit_cost_ghs:f"
      " inventory_value_ghs:f reorder_point:i days_of_supply:f is_below_reorder_point:b annualized_consumption:f"
      " inventory_turnover_ratio:f last_consumption_date:d days_since_last_consumption:i is_dead_stock:b"
      " dead_stock_value:f predictive_demand_signals:i predictive_demand_qty:i", "SELECT * FROM stock_mart")

check("warehouse_inventory_whole_units",
      "part_id:i part_number:s part_name:s part_category:s branch:s snapshot_date:d qty_on_hand:i unit_cost_ghs:f"
      " inventory_value_ghs:f reorder_point:i days_of_supply:f is_below_reorder_point:b annualized_consumption:f"
      " inventory_turnover_ratio:f last_consumption_date:d days_since_last_consumption:i is_dead_stock:b"
      " dead_stock_value:f predictive_demand_signals:i predictive_demand_qty:i", "SELECT * FROM stock_mart_whole")

check("baseline_demand", "part_id:i expected_qty:i demand_source:s", """
SELECT part_id, CEIL(SUM(qty_used) * 30.0 / (SELECT GREATEST(1, MAX(scheduled_date) - MIN(scheduled_date)) FROM consumed))
    AS expected_qty, 'Historical Baseline' AS demand_source
FROM consumed GROUP BY 1""")

check("parts_at_risk", "part_id:i expected_qty:i waiting_signals:i first_needed:d qty_on_hand:i", """
SELECT d.*, COALESCE(s.qty_on_hand, 0) AS qty_on_hand
FROM (SELECT part_id, SUM(expected_qty) AS expected_qty, COUNT(*) AS waiting_signals, MIN(needed_by_date) AS first_needed
      FROM demand WHERE is_primary GROUP BY 1) d
LEFT JOIN (SELECT part_id, SUM(qty_on_hand) AS qty_on_hand FROM inventory GROUP BY 1) s ON s.part_id = d.part_id
WHERE COALESCE(s.qty_on_hand, 0) < d.expected_qty""")

# Calendar and telemetry

check("calendar", "date_id:d year:i quarter:i month:i month_name:s day:i day_of_week:i is_weekend:b", """
SELECT day::DATE AS date_id, year(day) AS year, quarter(day) AS quarter, month(day) AS month, monthname(day) AS month_name,
  dayofmonth(day) AS day, isodow(day) AS day_of_week, isodow(day) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders) AS d""")

check("calendar_padded", "date_id:d year:i quarter:i month:i month_name:s day:i day_of_week:i is_weekend:b", """
SELECT day::DATE AS date_id, year(day) AS year, quarter(day) AS quarter, month(day) AS month,
  rpad(monthname(day), 9, ' ') AS month_name, dayofmonth(day) AS day, isodow(day) AS day_of_week, isodow(day) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders) AS d""")

_readings = ("fault_count_info:i fault_count_warning:i fault_count_critical:i avg_sensor_reading:f"
             " max_sensor_reading:f")
check("telemetry_daily_rollup", f"equipment_id:i date_id:d engine_hours:f utilization_hours:f {_readings}",
      "SELECT * FROM daily")

check("staged_telemetry", f"equipment_id:i date_id:d engine_hours:f utilization_hours:f {_readings} fault_count_total:i",
      "SELECT *, fault_count_info + fault_count_warning + fault_count_critical AS fault_count_total FROM daily")

# Predictive maintenance

check("fault_component_daily",
      "equipment_id:i component_id:i date_id:d daily_weighted_score:f daily_critical_count:i daily_fault_count:i", """
SELECT equipment_id, component_id, date_id, score AS daily_weighted_score, criticals AS daily_critical_count,
  faults AS daily_fault_count FROM scored""")

check("fault_trend", "date_id:d system_category:s faults:i criticals:i weighted_score:f", """
SELECT date_id, system_category, SUM(faults) AS faults, SUM(criticals) AS criticals, SUM(score) AS weighted_score
FROM scored JOIN units USING (component_id) GROUP BY 1, 2""")

check("dense_spine", "equipment_id:i model_id:i customer_id:i install_date:d date_id:d component_id:i",
      "SELECT * FROM spine")

check("maintenance_asof", "equipment_id:i date_id:d last_maint_date:d", "SELECT * FROM last_marks")

check("rolling_features",
      "equipment_id:i component_id:i date_id:d model_id:i customer_id:i daily_weighted_score:f daily_critical_count:i"
      " daily_fault_count:i weighted_score_7d:f weighted_score_14d:f weighted_score_30d:f critical_count_7d:i"
      " critical_count_14d:i machine_age_days:i engine_hours:f utilization_hours:f days_since_last_maintenance:i", """
SELECT r.equipment_id, r.component_id, r.date_id, r.model_id, r.customer_id, r.score AS daily_weighted_score,
  r.criticals AS daily_critical_count, r.faults AS daily_fault_count, r.score_7 AS weighted_score_7d,
  r.score_14 AS weighted_score_14d, r.score_30 AS weighted_score_30d, r.criticals_7 AS critical_count_7d,
  r.criticals_14 AS critical_count_14d, r.date_id - r.install_date AS machine_age_days, d.engine_hours,
  d.utilization_hours, COALESCE(r.date_id - l.last_maint_date, 9999) AS days_since_last_maintenance
FROM rolled r LEFT JOIN daily d ON d.equipment_id = r.equipment_id AND d.date_id = r.date_id
LEFT JOIN last_marks l ON l.equipment_id = r.equipment_id AND l.date_id = r.date_id""")

ORACLE["feature_increments"] = ORACLE["rolling_features"]

check("gbt_score_checks",
      "equipment_id:i component_id:i scoring_date:d weighted_score_7d:f critical_count_7d:i is_probability:i status_follows:i"
      " held_out_rows:i", """
SELECT r.equipment_id, r.component_id, r.date_id AS scoring_date, r.score_7 AS weighted_score_7d,
  r.criticals_7 AS critical_count_7d, 1 AS is_probability, 1 AS status_follows,
  (SELECT COUNT(*) FROM labelled l, newest n WHERE l.date_id >= n.day - 10) AS held_out_rows
FROM rolled r, newest WHERE r.date_id = newest.day""")

check("gbt_compiled",
      "equipment_id:i component_id:i scoring_date:d weighted_score_7d:f probabilities_agree:i statuses_agree:i", """
SELECT r.equipment_id, r.component_id, r.date_id AS scoring_date, r.score_7 AS weighted_score_7d, 1 AS probabilities_agree,
  1 AS statuses_agree
FROM rolled r, newest WHERE r.date_id = newest.day""")

check("gbt_evaluation", "positives:i negatives:i is_share:i auc_agrees:i precision_agrees:i recall_agrees:i", """
SELECT SUM(label) AS positives, SUM(1 - label) AS negatives, 1 AS is_share, 1 AS auc_agrees, 1 AS precision_agrees,
  1 AS recall_agrees
FROM labelled, newest WHERE date_id >= newest.day - 10""")

_graded = """
SELECT ROUND(0.02 + (0.98 - 0.02) / (1.0 + exp(-0.5 * (r.score_7::DOUBLE - 9.0))), 4) AS score, l.label
FROM labelled l JOIN rolled r USING (equipment_id, component_id, date_id) CROSS JOIN newest
WHERE l.date_id >= newest.day - 10"""

check("risk_threshold_curve", "threshold:f tp:i fp:i fn:i tn:i precision:f recall:f", f"""
SELECT threshold, tp, fp, fn, tn, ROUND(tp / (tp + fp), 6) AS precision, ROUND(tp / NULLIF(tp + fn, 0), 6) AS recall
FROM (SELECT h.threshold, COUNT(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
        COUNT(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
        COUNT(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
        COUNT(*) FILTER (WHERE score < threshold AND label = 0) AS tn
      FROM (SELECT DISTINCT score AS threshold FROM ({_graded})) h CROSS JOIN ({_graded}) g GROUP BY 1)""")

# the area as the mean rank of positive rows, ties taking the mean of their ranks
check("risk_evaluation", "auc:f positives:i negatives:i precision:f recall:f flagged:i", f"""
SELECT ROUND((SUM(place) FILTER (WHERE label = 1) - p::DOUBLE * (p + 1) / 2) / NULLIF(p::DOUBLE * n, 0), 6) AS auc,
  p AS positives, n AS negatives, ROUND(tp / NULLIF(flagged, 0), 6) AS precision, ROUND(tp / NULLIF(p, 0), 6) AS recall, flagged
FROM (SELECT label, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2 AS place,
        SUM(label) OVER () AS p, SUM(1 - label) OVER () AS n, COUNT(*) FILTER (WHERE score >= 0.5) OVER () AS flagged,
        COUNT(*) FILTER (WHERE score >= 0.5 AND label = 1) OVER () AS tp
      FROM ({_graded}))
GROUP BY p, n, tp, flagged""")

check("failure_labels", "equipment_id:i component_id:i date_id:d label:i", "SELECT * FROM labelled")

check("time_split_label_rate", "split:s row_count:i positives:i positive_rate:f", """
SELECT CASE WHEN date_id >= newest.day - 10 THEN 'test' ELSE 'train' END AS split, COUNT(*) AS row_count,
  SUM(label) AS positives, ROUND(AVG(label), 6) AS positive_rate
FROM labelled, newest GROUP BY 1""")

check("purged_split_label_rate", "split:s row_count:i positives:i positive_rate:f", """
SELECT CASE WHEN date_id >= newest.day - 10 THEN 'test' ELSE 'train' END AS split, COUNT(*) AS row_count,
  SUM(label) AS positives, ROUND(AVG(label), 6) AS positive_rate
FROM labelled, newest WHERE date_id >= newest.day - 10 OR date_id < newest.day - 15 GROUP BY 1""")

check("recent_faults", "equipment_id:i fault_code:s n:i", """
SELECT equipment_id, fault_code, COUNT(*) AS n FROM alerts, newest WHERE event_date >= newest.day - 7 GROUP BY 1, 2""")

# Signals

_signal = ("signal_id:i equipment_id:i scoring_date:d predicted_component_id:i failure_probability:f model_version:s"
           " recommended_action_window_days:i signal_status:s dismiss_reason:s")
check("risk_scored_signals", f"{_signal} contributing_fault_codes:s", "SELECT * FROM signals")
check("signals_triaged", _signal, "SELECT * FROM triaged")
check("status_frequency", "signal_status:s n:i", "SELECT signal_status, COUNT(*) AS n FROM triaged GROUP BY 1")
check("parts_demand",
      "forecast_id:i signal_id:i equipment_id:i part_id:i expected_qty:i is_primary:b needed_by_date:d demand_source:s",
      "SELECT * FROM demand")
check("parts_gaps", "gap_id:i signal_id:i component_id:i model_id:i resolved:b", "SELECT * FROM gaps")
check("catalog_gaps",
      "gap_id:i signal_id:i scoring_date:d equipment_id:i serial_number:s customer_id:i customer_name:s industry_name:s"
      " component_id:i component_name:s system_category:s model_id:i model_name:s category_name:s resolved:b",
      "SELECT * FROM gap_details")
check("catalog_gaps_summary",
      "model_id:i model_name:s category_name:s component_id:i component_name:s system_category:s total_gaps:i"
      " unresolved_gaps:i first_seen:d last_seen:d", """
SELECT model_id, model_name, category_name, component_id, component_name, system_category, COUNT(*) AS total_gaps,
  COUNT(*) FILTER (WHERE NOT resolved) AS unresolved_gaps, MIN(scoring_date) AS first_seen, MAX(scoring_date) AS last_seen
FROM gap_details GROUP BY 1, 2, 3, 4, 5, 6""")
check("work_orders_converted",
      "work_order_id:i equipment_id:i customer_id:i technician_id:i maintenance_type:s priority:s source_signal_id:i"
      " scheduled_date:d sla_target_hours:f warranty_flag:b status:s follow_up_required:b", "SELECT * FROM booked")
check("work_orders_appended",
      "work_order_id:i equipment_id:i maintenance_type:s priority:s scheduled_date:d downtime_hours:f total_cost:f"
      " status:s", """
SELECT work_order_id, equipment_id, maintenance_type, priority, scheduled_date, downtime_hours, total_cost, status FROM jobs
UNION ALL SELECT work_order_id, equipment_id, maintenance_type, priority, scheduled_date, NULL, NULL, status FROM booked""")

_enriched = ("signal_id:i equipment_id:i serial_number:s customer_id:i customer_name:s contract_tier:s model_name:s"
             " category_name:s scoring_date:d predicted_component_id:i component_name:s system_category:s"
             " failure_probability:f model_version:s recommended_action_window_days:i signal_status:s dismiss_reason:s"
             " resulting_work_order_id:i resulting_scheduled_date:d")
check("predictive_signals_enriched", _enriched, "SELECT * FROM enriched")
check("top_risk", _enriched, "SELECT * FROM enriched ORDER BY failure_probability DESC, signal_id LIMIT 200")

check("signal_funnel", "period_month:d system_category:s signals:i watched:i recommended:i booked:i", """
SELECT date_trunc('month', scoring_date)::DATE AS period_month, system_category, COUNT(*) AS signals,
  COUNT(*) FILTER (WHERE signal_status IN ('Watch', 'Action Recommended', 'Converted')) AS watched,
  COUNT(*) FILTER (WHERE signal_status IN ('Action Recommended', 'Converted')) AS recommended,
  COUNT(resulting_work_order_id) AS booked
FROM enriched GROUP BY 1, 2""")

check("signal_outcomes",
      "signal_id:i actual_outcome:s lead_time_delivered_days:i resulting_work_order_id:i", "SELECT * FROM outcomes")

check("outcome_precision", "signals:i decided:i confirmed:i precision:f avg_lead_time_days:f", """
SELECT COUNT(*) AS signals, COUNT(actual_outcome) AS decided, COUNT(*) FILTER (WHERE actual_outcome = 'Confirmed Failure') AS confirmed,
  ROUND(COUNT(*) FILTER (WHERE actual_outcome = 'Confirmed Failure')::DOUBLE / NULLIF(COUNT(actual_outcome), 0), 6) AS precision,
  ROUND(AVG(lead_time_delivered_days), 6) AS avg_lead_time_days
FROM outcomes""")

check("risk_confusion", "label:i prediction:i n:i", """
SELECT l.label, CASE WHEN r.score_7::DOUBLE >= 9.0 THEN 1 ELSE 0 END AS prediction, COUNT(*) AS n
FROM labelled l JOIN rolled r USING (equipment_id, component_id, date_id) CROSS JOIN newest
WHERE l.date_id >= newest.day - 10 GROUP BY 1, 2""")

check("signal_visits", "signal_id:i equipment_id:i due_date:d visit_no:i", """
SELECT t.signal_id, t.equipment_id, t.due_date, v.visit_no
FROM (SELECT signal_id, equipment_id, CAST(scoring_date + recommended_action_window_days AS DATE) AS due_date
      FROM triaged WHERE signal_status = 'Action Recommended') t
JOIN (SELECT equipment_id, due_date, SUM(is_start) OVER (PARTITION BY equipment_id ORDER BY due_date) AS visit_no
      FROM (SELECT equipment_id, due_date, CASE WHEN due_date - LAG(due_date) OVER (
                PARTITION BY equipment_id ORDER BY due_date) <= 3 THEN 0 ELSE 1 END AS is_start
            FROM (SELECT DISTINCT equipment_id, CAST(scoring_date + recommended_action_window_days AS DATE) AS due_date
                  FROM triaged WHERE signal_status = 'Action Recommended') AS u) AS w) v
  ON v.equipment_id = t.equipment_id AND v.due_date = t.due_date""")

check("signals_expired", "signal_status:s n:i", """
SELECT CASE WHEN signal_status IN ('New', 'Watch', 'Action Recommended')
    AND scoring_date + recommended_action_window_days < DATE '2024-02-12' THEN 'Expired' ELSE signal_status END
  AS signal_status, COUNT(*) AS n
FROM triaged GROUP BY 1""")

# Governance and quality

check("secure_sales", "customer_id:i event_date:d amount:f", """
SELECT customer_id, event_date, amount FROM lines
WHERE revenue_stream = 'Equipment Sales' AND customer_id IN (SELECT customer_id FROM clients WHERE region = 'ASIA')""")


check("secure_tax_filings",
      "customer_id:i period_start:d period_end:d vat_amount:f nhil_amount:f getfund_amount:f withholding_tax_amount:f"
      " filing_status:s",
      "SELECT * FROM filings WHERE customer_id IN (SELECT customer_id FROM clients WHERE region IN ('AMERICA', 'EUROPE'))")


def _seen(role: str, condition: str) -> str:
    return (f"SELECT '{role}' AS role, (SELECT COUNT(*) FROM clients WHERE {condition}) AS customers,"
            f" (SELECT COUNT(*) FROM lines JOIN clients USING (customer_id) WHERE revenue_stream = 'Equipment Sales'"
            f" AND {condition}) AS sales")


check("secure_row_counts", "role:s customers:i sales:i", " UNION ALL ".join([
    _seen("analyst", "region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"), _seen("analyst_asia", "region = 'ASIA'"),
    _seen("analyst_west", "region IN ('AMERICA', 'EUROPE')"), _seen("stranger", "false"), _seen("etl", "true")]))

check("audit_diff",
      "c_custkey:i table_name:s operation:s db_user:s old_balance:f new_balance:f old_segment:s new_segment:s", """
SELECT c_custkey, 'customer' AS table_name, 'DELETE' AS operation, 'loader' AS db_user, ROUND(c_acctbal, 2) AS old_balance,
  NULL AS new_balance, c_mktsegment AS old_segment, NULL AS new_segment FROM customer WHERE c_custkey % 17 = 0
UNION ALL SELECT c_custkey, 'customer', 'UPDATE', 'loader', ROUND(c_acctbal, 2),
  ROUND(CASE WHEN c_custkey % 13 = 0 THEN c_acctbal + 1 ELSE c_acctbal END, 2), c_mktsegment,
  CASE WHEN c_custkey % 11 = 0 THEN 'MOVED' ELSE c_mktsegment END FROM customer
WHERE c_custkey % 17 <> 0 AND (c_custkey % 13 = 0 OR c_custkey % 11 = 0)
UNION ALL SELECT c_custkey + 1000000000, 'customer', 'INSERT', 'loader', NULL, ROUND(c_acctbal, 2), NULL, c_mktsegment
FROM customer WHERE c_custkey % 19 = 0""")



def _changes(table: str, key: str, value: str) -> str:
    return f"""
SELECT {key} AS row_key, '{table}' AS table_name, 'DELETE' AS operation, ROUND({value}, 2) AS old_value, NULL AS new_value
FROM {table} WHERE {key} % 17 = 0
UNION ALL SELECT {key}, '{table}', 'UPDATE', ROUND({value}, 2), ROUND({value} + 1, 2)
FROM {table} WHERE {key} % 17 <> 0 AND {key} % 13 = 0
UNION ALL SELECT {key} + 1000000000, '{table}', 'INSERT', NULL, ROUND({value}, 2) FROM {table} WHERE {key} % 19 = 0"""


check("audit_four_tables", "row_key:i table_name:s operation:s old_value:f new_value:f", " UNION ALL ".join([
    _changes("customer", "c_custkey", "c_acctbal"), _changes("orders", "o_orderkey", "o_totalprice"),
    _changes("part", "p_partkey", "p_retailprice"), _changes("supplier", "s_suppkey", "s_acctbal")]))

_near = "(o_orderkey BETWEEN 300 AND 2900 OR o_orderkey BETWEEN 4000 AND 5100)"
check("audit_parts", "o_orderkey:i operation:s old_price:f new_price:f", f"""
SELECT o_orderkey, 'DELETE' AS operation, ROUND(o_totalprice, 2) AS old_price, NULL AS new_price
FROM orders WHERE {_near} AND o_orderkey % 17 = 0
UNION ALL SELECT o_orderkey, 'UPDATE', ROUND(o_totalprice, 2), ROUND(o_totalprice + 1, 2)
FROM orders WHERE {_near} AND o_orderkey % 17 <> 0 AND o_orderkey % 13 = 0
UNION ALL SELECT -o_orderkey, 'INSERT', NULL, ROUND(o_totalprice, 2) FROM orders WHERE {_near} AND o_orderkey % 19 = 0""")

check("encrypt_rotation", "c_custkey:i key_id:i decrypted:s swapped_opens:b opens_without_key_2:b", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS key_id, c_name AS decrypted,
  false AS swapped_opens, c_custkey % 2 = 0 AS opens_without_key_2
FROM customer""")

check("fault_code_index", "fault_code:s signal_id:i position:i", """
SELECT listed[i] AS fault_code, signal_id, i - 1 AS position
FROM (SELECT *, unnest(range(1, len(listed) + 1)) AS i
      FROM (SELECT signal_id, string_split(contributing_fault_codes, ',') AS listed FROM signals WHERE contributing_fault_codes IS NOT NULL))""")

check("machines_served", "grain:s branch:s period_start:d exact:i within_bound:i", " UNION ALL ".join(f"""
SELECT '{grain}' AS grain, region AS branch, date_trunc('{grain}', scheduled_date)::DATE AS period_start,
  COUNT(DISTINCT equipment_id) AS exact, 1 AS within_bound
FROM jobs JOIN clients USING (customer_id) GROUP BY ALL""" for grain in ("quarter", "year")))

check("streams_landed", "topic:s landed:i quarantined:i stored:i", """
SELECT 'faults' AS topic, COUNT(*) AS landed, COUNT(*) FILTER (WHERE equipment_id % 5 = 0) AS quarantined, COUNT(*) AS stored FROM alerts
UNION ALL SELECT 'telemetry_daily', COUNT(*), COUNT(*) FILTER (WHERE equipment_id % 5 = 0), COUNT(*) FROM daily""")

check("encrypt_roundtrip", "c_custkey:i decrypted:s matches:b cipher_bytes:i", """
SELECT c_custkey, c_name AS decrypted, true AS matches, strlen(c_name) + 28 AS cipher_bytes FROM customer""")


def _violations(pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {rows}" for name, rows in pairs.items())


def _repeated(table: str, keys: str, where: str = "true") -> str:
    return f"(SELECT {keys} FROM {table} WHERE {where} GROUP BY {keys} HAVING COUNT(*) > 1) AS d"


check("quality_report", "check_name:s violations:i", _violations({
    "customers: customer_id not null": "clients WHERE customer_id IS NULL",
    "customers: customer_name not null": "clients WHERE customer_name IS NULL",
    "customers: region not null": "clients WHERE region IS NULL",
    "customers: contract_tier in domain": "clients WHERE contract_tier NOT IN ('Silver', 'Gold', 'Platinum')",
    "customers: customer_id unique": _repeated("clients", "customer_id"),
    "customers: customer_name unique": _repeated("clients", "customer_name"),
    "equipment: equipment_id not null": "machines WHERE equipment_id IS NULL",
    "equipment: model_id not null": "machines WHERE model_id IS NULL",
    "equipment: ownership_type in domain": "machines WHERE ownership_type NOT IN ('Owned', 'Rented')",
    "equipment: status in domain": "machines WHERE status NOT IN ('Active', 'Idle')",
    "equipment: equipment_id unique": _repeated("machines", "equipment_id"),
    "equipment: serial_number unique": _repeated("machines", "serial_number"),
    "equipment: customer_id in customers": "machines WHERE customer_id NOT IN (SELECT customer_id FROM clients)",
    "work_orders: work_order_id not null": "jobs WHERE work_order_id IS NULL",
    "work_orders: technician_id not null":
        "jobs j LEFT JOIN assigned a ON a.work_order_id = j.work_order_id WHERE a.technician_id IS NULL",
    "work_orders: actual_completion not null": "jobs WHERE actual_completion IS NULL",
    "work_orders: priority in domain": "jobs WHERE priority NOT IN ('Critical', 'High', 'Routine')",
    "work_orders: work_order_id unique": _repeated("jobs", "work_order_id"),
    "work_orders: equipment_id in equipment": "jobs WHERE equipment_id NOT IN (SELECT equipment_id FROM machines)",
    "order_lines: l_orderkey not null": "lineitem WHERE l_orderkey IS NULL",
    "order_lines: l_linenumber not null": "lineitem WHERE l_linenumber IS NULL",
    "order_lines: l_partkey not null": "lineitem WHERE l_partkey IS NULL",
    "order_lines: quantity at most 40": "lineitem WHERE l_quantity > 40",
    "order_lines: l_orderkey+l_linenumber unique": _repeated("lineitem", "l_orderkey, l_linenumber"),
    "order_lines: l_orderkey in work_orders": "lineitem WHERE l_orderkey NOT IN (SELECT work_order_id FROM jobs)",
}))

# Every declared rule counted by itself. A table names what fills it and which of its columns that gives; the rest are NULL.
_FILLED = {
    "dim_industry": ("industries", "industry_id industry_name"),
    "dim_customer": ("clients", "customer_id customer_name customer_type industry_id region contract_tier"),
    "dim_equipment": ("""(SELECT * REPLACE (CASE WHEN equipment_id % 53 = 0 THEN customer_id + 1000000000 ELSE customer_id END
        AS customer_id) FROM (SELECT * FROM machines UNION ALL SELECT * FROM machines WHERE equipment_id % 97 = 0))""",
        "equipment_id model_id serial_number customer_id install_date ownership_type status"),
    "dim_equipment_model": ("(SELECT n_nationkey AS model_id, n_regionkey AS category_id, n_name AS model_name FROM nation)",
                            "model_id category_id model_name"),
    "dim_equipment_category": ("""(SELECT r_regionkey AS category_id, r_name AS category_name, CASE r_regionkey % 3 WHEN 0 THEN 'Mining'
        WHEN 1 THEN 'Construction' ELSE 'Both' END AS primary_application FROM region)""", "category_id category_name primary_application"),
    "dim_component": ("units", "component_id component_name system_category"),
    "dim_technician": ("(SELECT s_suppkey AS technician_id, s_name AS technician_name, branch FROM crews JOIN supplier ON s_suppkey = technician_id)",
                       "technician_id technician_name branch"),
    "dim_part": ("wares", "part_id part_number part_name part_category unit_cost lead_time_days"),
    "dim_date": ("""(SELECT d::DATE AS date_id, 1 AS year, 1 AS quarter, 1 AS month, '' AS month_name, 1 AS day, 1 AS day_of_week,
        false AS is_weekend FROM (SELECT unnest(generate_series(MIN(o_orderdate)::DATE, MAX(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d
        FROM orders))""", "date_id year quarter month month_name day day_of_week is_weekend"),
    "bridge_component_part": ("(SELECT * FROM (VALUES (1, 'ECONOMY'), (1, 'SMALL'), (2, 'MEDIUM'), (2, 'UNLISTED'), (12, 'LARGE'))"
                              " AS v(component_id, part_category), (SELECT 1 AS typical_qty, true AS is_primary))",
                              "component_id part_category typical_qty is_primary"),
    "bridge_faultcode_component": ("(SELECT *, weight AS correlation_weight FROM bridge)", "fault_code component_id correlation_weight"),
    "fact_equipment_sales": ("sales", "sale_id equipment_id customer_id sale_date sale_price cost_basis"),
    "fact_rental_contracts": ("rentals", "rental_id equipment_id customer_id start_date end_date rate_type rate total_billed"),
    "fact_telemetry_daily": ("daily", "equipment_id date_id fault_count_info fault_count_warning fault_count_critical"),
    "fact_fault_events": ("alerts", "equipment_id event_date fault_code severity"),
    "fact_maintenance_events": ("(SELECT *, true AS warranty_flag FROM jobs)",
                                "work_order_id equipment_id customer_id maintenance_type priority source_signal_id scheduled_date"
                                " warranty_flag status"),
    "fact_maintenance_parts_used": ("used", "work_order_id part_id qty_used"),
    "fact_tax_filings": ("filings", "customer_id period_start period_end vat_amount nhil_amount getfund_amount"
                         " withholding_tax_amount filing_status"),
    "ml_maintenance_signals": ("triaged", "signal_id equipment_id scoring_date predicted_component_id failure_probability"
                               " model_version signal_status"),
    "parts_demand_forecast": ("demand", "forecast_id signal_id equipment_id part_id expected_qty is_primary demand_source"),
    "parts_mapping_gaps": ("gaps", "gap_id signal_id component_id model_id resolved"),
}


def _declared() -> str:
    parts = []

    def count(name: str, rows: str) -> None:
        parts.append(f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {rows}")

    for table, (source, given) in _FILLED.items():
        rules, columns = CONSTRAINTS[table], given.split()
        for c in (*rules.key, *rules.not_null):
            count(f"{table}: {c} not null", f"{source} AS t WHERE {c if c in columns else 'NULL'} IS NULL")
        for c, values in rules.allowed.items():
            listed = ", ".join(f"'{v}'" for v in values)
            count(f"{table}: {c} in domain", f"{source} AS t WHERE {c if c in columns else 'NULL'} NOT IN ({listed})")
        for name, violated in rules.rules.items():
            count(f"{table}: {name}", f"{source} AS t WHERE {violated}")
        for key in (rules.key, *rules.unique):
            names = ", ".join(key)
            whole = " AND ".join(f"{c} IS NOT NULL" if c in columns else "false" for c in key)
            inner = f"(SELECT {names} FROM {source} AS t WHERE {whole} GROUP BY ALL HAVING COUNT(*) > 1)"
            count(f"{table}: {'+'.join(key)} unique", f"{inner} AS d" if set(key) <= set(columns) else f"{source} AS t WHERE false")
        for c, (parent, parent_column) in rules.references.items():
            if parent not in _FILLED:
                parts.append(f"SELECT '{table}: {c} in {parent} (not checked)', NULL")
                continue
            known = f"SELECT {parent_column} FROM {_FILLED[parent][0]} AS p WHERE {parent_column} IS NOT NULL"
            lost = f"{c} IS NOT NULL AND {c} NOT IN ({known})" if c in columns else "false"
            count(f"{table}: {c} in {parent}", f"{source} AS t WHERE {lost}")
    return " UNION ALL ".join(parts)


check("declared_constraints", "check_name:s violations:i", _declared())

check("staged_faults", "event_id:i equipment_id:i event_date:d fault_code:s severity:s", """
SELECT event_id, user_id AS equipment_id, ts::DATE AS event_date, event_type AS fault_code,
  CASE event_type WHEN 'error' THEN 'Critical' WHEN 'purchase' THEN 'Warning' WHEN 'click' THEN 'Warning' ELSE 'Info' END AS severity
FROM events""")

_sites = "(SELECT *, customer_id * 10 + n AS site_id, 'Site' AS site_name FROM clients CROSS JOIN (VALUES (0), (1)) AS v(n) WHERE n = 0 OR customer_id % 3 = 0)"

# what each staging model shows, and what fills its columns; the others are empty
_STAGED = {
    "stg_industries": ("dim_industry", "industry_id,industry_name"),
    "stg_customers": ("dim_customer", "customer_id,customer_code,customer_name,customer_type,industry_id,region,contract_tier"),
    "stg_sites": ("dim_site", "site_id,site_name,customer_id,region,latitude,longitude"),
    "stg_equipment": ("dim_equipment", "equipment_id,model_id,serial_number,customer_id,site_id,install_date,ownership_type,status"),
    "stg_equipment_models": ("dim_equipment_model", "model_id,category_id,model_name,engine_series,list_price_usd"),
    "stg_equipment_categories": ("dim_equipment_category", "category_id,category_name,primary_application"),
    "stg_components": ("dim_component", "component_id,component_name,system_category"),
    "stg_parts": ("dim_part", "part_id,part_number,part_name,part_category,unit_cost_usd,lead_time_days"),
    "stg_technicians": ("dim_technician", "technician_id,technician_name,branch,certification_level"),
    "stg_maintenance_parts_used": ("fact_maintenance_parts_used", "work_order_id,part_id,qty_used"),
    "stg_ml_signals": ("ml_maintenance_signals",
                       "signal_id,equipment_id,scoring_date,predicted_component_id,failure_probability,model_version,"
                       "recommended_action_window_days,contributing_fault_codes,signal_status,dismiss_reason,created_at"),
    "stg_parts_demand_forecast": ("parts_demand_forecast",
                                  "forecast_id,signal_id,equipment_id,part_id,expected_qty,is_primary,needed_by_date,demand_source"),
    "stg_parts_mapping_gaps": ("parts_mapping_gaps", "gap_id,signal_id,component_id,model_id,resolved"),
}
_SOURCES = _FILLED | {
    "dim_site": (_sites, "site_id site_name customer_id region"),
    "dim_equipment": ("(SELECT *, 1 AS site_id FROM machines)",
                      "equipment_id model_id serial_number customer_id site_id install_date ownership_type status"),
    "dim_part": ("(SELECT *, unit_cost AS unit_cost_usd FROM wares)", "part_id part_number part_name part_category unit_cost_usd lead_time_days"),
    "ml_maintenance_signals": ("(SELECT *, 1 AS created_at FROM triaged)",
                               "signal_id equipment_id scoring_date predicted_component_id failure_probability model_version"
                               " recommended_action_window_days contributing_fault_codes signal_status dismiss_reason created_at"),
    "parts_demand_forecast": ("demand", "forecast_id signal_id equipment_id part_id expected_qty is_primary needed_by_date demand_source"),
}


def _staged() -> str:
    parts = []
    for model, (table, shown) in _STAGED.items():
        source, given = _SOURCES[table]
        empty = " + ".join(f"({c} IS NULL)::INT" if c in given.split() else "1" for c in shown.split(","))
        key = ", ".join(CONSTRAINTS[table].key)
        parts.append(f"SELECT '{model}' AS model, COUNT(*) AS n_rows, '{shown}' AS columns, COUNT(DISTINCT ({key})) AS distinct_keys,"
                     f" COALESCE(SUM({empty}), 0) AS empty_cells FROM {source} AS t")
    return " UNION ALL ".join(parts)


check("staged_tables", "model:s n_rows:i columns:s distinct_keys:i empty_cells:i", _staged())

check("signals_stamped", "signal_id:i model_version:s created_on:d n_codes:i", """
SELECT signal_id, model_version, DATE '2024-01-31' AS created_on, COALESCE(len(string_split(contributing_fault_codes, ',')), 0) AS n_codes
FROM signals""")

check("confirmed_failures", "equipment_id:i component_id:i failure_date:d", "SELECT * FROM failed")

_roles = {"analyst": "region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')", "analyst_asia": "region = 'ASIA'",
          "analyst_west": "region IN ('AMERICA', 'EUROPE')", "stranger": "false", "etl": "true"}
check("secure_sites", "role:s region:s customers:i sites:i", " UNION ALL ".join(
    f"SELECT '{role}' AS role, region, COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS sites FROM {_sites} AS t WHERE {seen} GROUP BY region"
    for role, seen in _roles.items()))

_branch = "branch NOT IN (SELECT r_name FROM region)"
_fleet = "(SELECT * FROM fleet UNION ALL SELECT * FROM fleet WHERE equipment_id % 97 = 0) AS f"
check("result_checks", "check_name:s violations:i", _violations({
    "finance_monthly: customer_id not null": "finance WHERE customer_id IS NULL",
    "finance_monthly: industry_id not null": "finance WHERE industry_id IS NULL",
    "finance_monthly: total_revenue not null": "finance WHERE total_revenue IS NULL",
    "customer_concentration: customer_id not null": "standing WHERE customer_id IS NULL",
    "customer_concentration: revenue_rank not null": "standing WHERE revenue_rank IS NULL",
    "customer_concentration: customer_id unique": _repeated("standing", "customer_id"),
    "fleet_operations: equipment_id not null": f"{_fleet} WHERE equipment_id IS NULL",
    "fleet_operations: ownership_type in domain":
        f"{_fleet} WHERE equipment_id % 61 = 0 OR ownership_type NOT IN ('Owned', 'Rented')",
    "fleet_operations: equipment_id unique": "(SELECT equipment_id FROM " + _fleet + " GROUP BY 1 HAVING COUNT(*) > 1) AS d",
    "predictive_signals: signal_id not null": "enriched WHERE signal_id IS NULL",
    "predictive_signals: failure_probability not null": "enriched WHERE failure_probability IS NULL",
    "predictive_signals: signal_status in domain":
        "enriched WHERE signal_status NOT IN ('New', 'Watch', 'Action Recommended', 'Reviewed', 'Converted', 'Dismissed', 'Expired')",
    "predictive_signals: failure probability in range":
        "enriched WHERE signal_id % 89 = 0 OR failure_probability < 0 OR failure_probability > 1",
    "predictive_signals: signal_id unique": _repeated("enriched", "signal_id"),
    "warehouse_inventory: part_id not null": "stock_mart WHERE part_id IS NULL",
    "warehouse_inventory: branch not null": "stock_mart WHERE part_id % 83 <> 0 AND branch IS NULL",
    "warehouse_inventory: snapshot_date not null": "stock_mart WHERE snapshot_date IS NULL",
    "warehouse_inventory: unit_cost_ghs not null": "stock_mart WHERE unit_cost_ghs IS NULL",
    "warehouse_inventory: branch in domain": f"stock_mart WHERE part_id % 83 = 0 OR {_branch}",
    "warehouse_inventory: inventory value not negative": "stock_mart WHERE inventory_value_ghs < 0",
    "warehouse_inventory: part_id+branch+snapshot_date unique":
        "(SELECT part_id FROM stock_mart GROUP BY part_id, CASE WHEN part_id % 83 = 0 THEN 'Nowhere' ELSE branch END,"
        " snapshot_date HAVING COUNT(*) > 1) AS d",
    "branch_performance: branch in domain": f"""(
      SELECT DISTINCT t.branch, date_trunc('month', j.scheduled_date) AS m FROM jobs j
      JOIN assigned a ON a.work_order_id = j.work_order_id JOIN crews t ON t.technician_id = a.technician_id
      WHERE j.status = 'Completed' AND t.{_branch}) AS b""",
    "catalog_gaps: gap_id not null": "gap_details WHERE gap_id IS NULL",
    "catalog_gaps: component_id not null": "gap_details WHERE component_id IS NULL",
    "catalog_gaps: model_id not null": "gap_details WHERE model_id IS NULL",
    "catalog_gaps: gap_id unique": _repeated("gap_details", "gap_id"),
}))

# Messages, streams and sinks

check("json_publish", "key:s value:s", """
SELECT CAST(equipment_id AS VARCHAR) AS key, '{"equipment_id":' || equipment_id || ',"event_date":"' || event_date
  || '","fault_code":"' || fault_code || '","severity":"' || severity || '"}' AS value FROM alerts""")
check("insert_if_absent", "c_custkey:i c_name:s", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'new ' || c_name END AS c_name FROM customer""")
check("stream_fault_append", "equipment_id:i event_date:d fault_code:s severity:s", "SELECT * FROM alerts")
check("stream_upsert_daily", f"equipment_id:i utilization_hours:f {_readings} date_id:d", "SELECT * FROM daily")
check("stream_daily_rollup",
      "equipment_id:i fault_count_info:i fault_count_warning:i fault_count_critical:i event_count:i max_sensor_reading:f"
      " date_id:d", """
SELECT d.equipment_id, d.fault_count_info, d.fault_count_warning, d.fault_count_critical, e.n AS event_count,
  e.peak AS max_sensor_reading, d.date_id
FROM daily d JOIN (SELECT user_id AS equipment_id, ts::DATE AS date_id, COUNT(*) AS n, MAX(value) AS peak FROM events GROUP BY 1, 2) e
  ON e.equipment_id = d.equipment_id AND e.date_id = d.date_id""")
check("numbered_orders", "o_orderkey:i order_date:d order_no:i", """
SELECT o_orderkey, o_orderdate::DATE AS order_date, ROW_NUMBER() OVER (ORDER BY o_orderdate::DATE, o_orderkey) AS order_no
FROM orders""")
ORACLE["stream_late_rollup"] = ORACLE["stream_daily_rollup"]
