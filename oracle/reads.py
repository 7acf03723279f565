"""Oracle SQL of the read layer (KPI reads, read-time ratios, ranked reads, checks)."""

from __future__ import annotations

from strata.plans.kpi import COMPARISON_MONTHS, KPIS

from .tables import SD


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _catalog_values() -> str:
    rows = []
    for k in KPIS:
        target = "NULL" if k.target is None else f"{float(k.target)!r}"
        rows.append(f"({_q(k.key)}, {_q(k.dashboard)}, {k.order}, {_q(k.table)}, {_q(k.column)}, {_q(k.direction)}, "
                    f"{_q(k.threshold_op)}, CAST({float(k.threshold)!r} AS DOUBLE), CAST({target} AS DOUBLE), "
                    f"{_q(k.comparison)}, {COMPARISON_MONTHS[k.comparison]}, {100.0 if k.fraction else 1.0})")
    cols = ("kpi, dashboard, display_order, source_table, value_column, direction, threshold_op, threshold, "
            "target, comparison, comparison_months, scale")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t({cols})"


def _values_sql() -> str:
    parts = []
    for k in KPIS:
        parts.append(f"SELECT {_q(k.table)} AS source_table, {_q(k.column)} AS value_column, month, "
                     f"CAST({k.column} AS DOUBLE) AS value FROM {k.table}")
    return "\nUNION ALL ".join(parts)


EXEC_DEPS = ("exec_kpi_month", "exec_it_kpi_month")

# name -> (dependencies, body, (integral columns, non-integral columns))
READS: dict[str, tuple[tuple[str, ...], str, tuple[str, str]]] = {}

READS["kpi_catalog"] = ((), _catalog_values(), ("display_order comparison_months", "threshold target scale"))
READS["kpi_values"] = (EXEC_DEPS, _values_sql(), ("", "value"))

READS["kpi_latest"] = (("kpi_catalog", "kpi_values"), """
SELECT c.kpi, c.dashboard, c.display_order, v.month, v.value
FROM kpi_catalog c JOIN kpi_values v ON c.source_table = v.source_table AND c.value_column = v.value_column
WHERE v.month = (SELECT max(month) FROM kpi_values x WHERE x.source_table = v.source_table)""",
                       ("display_order", "value"))

READS["kpi_trend"] = (("kpi_catalog", "kpi_values"), """
SELECT c.kpi, strftime(v.month, '%Y-%m-%d') AS period, v.value
FROM kpi_catalog c JOIN (
  SELECT *, row_number() OVER (PARTITION BY source_table, value_column ORDER BY month NULLS FIRST) AS rn FROM kpi_values) v
  ON c.source_table = v.source_table AND c.value_column = v.value_column
WHERE v.rn <= 13""", ("", "value"))

READS["kpi_scorecard"] = (("kpi_catalog", "kpi_values"), """
WITH cur AS (
  SELECT c.*, v.month, v.value, CAST(v.month - to_months(c.comparison_months) AS DATE) AS prior_month
  FROM kpi_catalog c JOIN kpi_values v ON c.source_table = v.source_table AND c.value_column = v.value_column
  WHERE v.month = (SELECT max(month) FROM kpi_values x WHERE x.source_table = v.source_table)),
s AS (
  SELECT cur.*, p.value AS prior_value, cur.value * cur.scale AS display_value, cur.value - p.value AS delta
  FROM cur LEFT JOIN kpi_values p ON p.source_table = cur.source_table AND p.value_column = cur.value_column
   AND p.month = cur.prior_month)
SELECT kpi, dashboard, display_order, month, value, display_value, comparison, prior_month, prior_value, delta,
  delta / NULLIF(abs(prior_value), 0) AS delta_pct,
  CASE WHEN direction = 'higher' THEN delta > 0 ELSE delta < 0 END AS improving,
  CASE WHEN display_value IS NULL THEN NULL
       WHEN (CASE threshold_op WHEN '>=' THEN display_value >= threshold WHEN '>' THEN display_value > threshold
                               WHEN '<' THEN display_value < threshold WHEN '<=' THEN display_value <= threshold END)
       THEN 'good' ELSE 'bad' END AS status,
  target, display_value - target AS target_gap
FROM s""", ("display_order", "value display_value prior_value delta delta_pct target target_gap"))

READS["payer_revenue_ratios"] = (("fact_revenue_cycle_month",), f"""
SELECT payer_id, sum(total_claims) AS total_claims, sum(denied_claims) AS denied_claims,
  sum(appeals_decided) AS appeals_decided, sum(appeals_won) AS appeals_won,
  {SD('sum(denied_claims)', 'sum(total_claims)')} AS denial_rate,
  {SD('sum(appeals_won)', 'sum(appeals_decided)')} AS win_rate
FROM fact_revenue_cycle_month GROUP BY payer_id""",
                                 ("total_claims denied_claims appeals_decided appeals_won", "denial_rate win_rate"))

READS["facility_labor_ratios"] = (("fact_workforce_month",), f"""
SELECT facility_id, sum(worked_hours) AS worked_hours, sum(agency_hours) AS agency_hours,
  sum(overtime_hours) AS overtime_hours, sum(total_labor_cost) AS total_labor_cost,
  {SD('sum(agency_hours)', 'sum(worked_hours)')} AS agency_pct,
  {SD('sum(total_labor_cost)', 'sum(worked_hours)')} AS cost_per_worked_hour,
  {SD('sum(overtime_hours)', 'sum(worked_hours)')} AS ot_pct
FROM fact_workforce_month GROUP BY facility_id""",
                                  ("", "worked_hours agency_hours overtime_hours total_labor_cost agency_pct "
                                       "cost_per_worked_hour ot_pct"))

READS["bed_occupancy"] = (("fact_throughput_month", "dim_facility"), f"""
SELECT t.month, t.facility_id, t.ip_los_sum, d.bed_capacity,
  {SD('t.ip_los_sum', 'd.bed_capacity * dayofmonth(last_day(t.month))')} AS bed_occupancy
FROM fact_throughput_month t JOIN dim_facility d ON t.facility_id = d.facility_id""",
                          ("bed_capacity", "ip_los_sum bed_occupancy"))

READS["ar_days_daily"] = (("fact_charge_capture_day",), f"""
SELECT day, sum(claims_billed_amount) AS claims_billed_amount, sum(claims_paid_amount) AS claims_paid_amount,
  30.0 * (1 - coalesce({SD('sum(claims_paid_amount)', 'sum(claims_billed_amount)')}, 0)) AS ar_days_proxy
FROM fact_charge_capture_day GROUP BY day""", ("", "claims_billed_amount claims_paid_amount ar_days_proxy"))

READS["incident_ratios"] = (("fact_it_incident_month",), f"""
SELECT system_id, sum(incident_count) AS incident_count,
  {SD('sum(resolution_minutes_sum)', 'sum(resolved_count)')} AS mttr_minutes,
  {SD('sum(within_sla_count)', 'sum(incident_count)')} AS pct_within_sla,
  {SD('sum(clinical_downtime_count)', 'sum(incident_count)')} AS pct_clinical
FROM fact_it_incident_month GROUP BY system_id""", ("incident_count", "mttr_minutes pct_within_sla pct_clinical"))

READS["security_ratios"] = (("fact_it_security_month",), f"""
SELECT facility_id, severity, sum(remediated_count) AS remediated_count,
  {SD('sum(within_sla_count)', 'sum(within_sla_count) + sum(sla_breached_count)')} AS vuln_sla_pct,
  {SD('sum(remediation_days_sum)', 'sum(remediated_count)')} AS mean_remediation_days
FROM fact_it_security_month GROUP BY facility_id, severity""",
                            ("remediated_count", "vuln_sla_pct mean_remediation_days"))

READS["cloud_waste_pct"] = (("fact_it_cost_month",), f"""
SELECT system_id, sum(cloud_cost) AS cloud_cost, sum(cloud_idle_cost) AS cloud_idle_cost,
  {SD('sum(cloud_idle_cost)', 'sum(cloud_cost)')} AS cloud_waste_pct
FROM fact_it_cost_month GROUP BY system_id""", ("", "cloud_cost cloud_idle_cost cloud_waste_pct"))

READS["change_lead_time"] = (("fact_it_servicedesk_month",), f"""
SELECT month, sum(change_total) AS change_total,
  {SD('sum(change_lead_time_minutes_sum)', 'sum(change_total)')} AS avg_change_lead_minutes
FROM fact_it_servicedesk_month GROUP BY month""", ("change_total", "avg_change_lead_minutes"))

READS["dex_ratios"] = (("fact_it_dex_month",), f"""
SELECT facility_id, {SD('sum(login_seconds_sum)', 'sum(login_observations)')} AS mean_login_latency,
  {SD('sum(governed_session_count)', 'sum(ai_sessions_sum)')} AS governed_share
FROM fact_it_dex_month GROUP BY facility_id""", ("", "mean_login_latency governed_share"))


READS["top_underpayments"] = (("worklist_underpayments",), """
SELECT *, rank() OVER (ORDER BY underpayment_variance DESC NULLS LAST) AS rank FROM worklist_underpayments""",
                              ("rank", "total_billed_amount total_allowed_amount total_paid_amount "
                                       "underpayment_variance underpayment_pct"))
READS["top_cloud_waste"] = (("worklist_cloud_waste",), """
SELECT *, rank() OVER (ORDER BY annualized_savings DESC NULLS LAST) AS rank FROM worklist_cloud_waste""",
                            ("rank", "cloud_cost cloud_idle_pct monthly_idle_amount annualized_savings"))
READS["ranked_eol_refresh"] = (("worklist_eol_refresh",), """
SELECT *, rank() OVER (ORDER BY refresh_priority_score DESC) AS rank FROM worklist_eol_refresh""",
                               ("days_past_eol open_critical_findings refresh_priority_score rank", "annual_run_cost"))
READS["ranked_open_vulns"] = (("worklist_open_critical_vulns",), """
SELECT *, rank() OVER (ORDER BY exposure_score DESC) AS rank FROM worklist_open_critical_vulns""",
                              ("days_open exposure_score rank", ""))
READS["ranked_duplicate_pairs"] = (("worklist_empi_duplicate_pairs",), """
SELECT *, rank() OVER (ORDER BY min_confidence ASC NULLS LAST) AS rank FROM worklist_empi_duplicate_pairs""",
                                   ("rank", "confidence_a confidence_b min_confidence"))

READS["payer_month_revenue_ratios"] = (("fact_revenue_cycle_month",), f"""
SELECT payer_id, month, sum(total_claims) AS total_claims, sum(denied_claims) AS denied_claims,
  sum(appeals_decided) AS appeals_decided, sum(appeals_won) AS appeals_won,
  {SD('sum(denied_claims)', 'sum(total_claims)')} AS denial_rate,
  {SD('sum(appeals_won)', 'sum(appeals_decided)')} AS win_rate
FROM fact_revenue_cycle_month GROUP BY payer_id, month""",
                                       ("total_claims denied_claims appeals_decided appeals_won", "denial_rate win_rate"))

READS["region_month_labor_ratios"] = (("fact_workforce_month",), f"""
SELECT region, month, sum(worked_hours) AS worked_hours, sum(agency_hours) AS agency_hours,
  sum(overtime_hours) AS overtime_hours, sum(total_labor_cost) AS total_labor_cost,
  {SD('sum(agency_hours)', 'sum(worked_hours)')} AS agency_pct,
  {SD('sum(total_labor_cost)', 'sum(worked_hours)')} AS cost_per_worked_hour,
  {SD('sum(overtime_hours)', 'sum(worked_hours)')} AS ot_pct
FROM fact_workforce_month GROUP BY region, month""",
                                      ("", "worked_hours agency_hours overtime_hours total_labor_cost agency_pct "
                                           "cost_per_worked_hour ot_pct"))

READS["kpi_trend_latest"] = (("kpi_catalog", "kpi_values"), """
SELECT c.kpi, strftime(v.month, '%Y-%m-%d') AS period, v.value
FROM kpi_catalog c JOIN kpi_values v ON c.source_table = v.source_table AND c.value_column = v.value_column
WHERE (SELECT count(*) FROM kpi_values x WHERE x.source_table = v.source_table AND x.value_column = v.value_column
       AND x.month > v.month) < 13 AND v.month IS NOT NULL""", ("", "value"))

_IT_TABLES = ("dim_it_system", "dim_it_asset", "exec_it_kpi_month", "fact_it_incident_month", "fact_it_security_month",
              "fact_it_cost_month", "fact_it_servicedesk_month", "fact_it_dex_month", "worklist_open_critical_vulns",
              "worklist_eol_refresh", "worklist_app_rationalization", "worklist_cloud_waste",
              "worklist_vendor_renewals")
READS["check_it_nonempty"] = (_IT_TABLES, "\nUNION ALL ".join(
    f"SELECT '{t}' AS t, {sorted(_IT_TABLES).index(t) + 1} AS place, count(*) AS n FROM {t}" for t in _IT_TABLES),
                              ("place n", ""))

READS["check_exec_it"] = (("exec_it_kpi_month",), """
SELECT count(*) AS months, count(*) FILTER (WHERE change_failure_rate IS NULL) AS null_cfr,
  round(avg(service_availability_pct), 4) AS avg_avail
FROM exec_it_kpi_month""", ("months null_cfr", "avg_avail"))
