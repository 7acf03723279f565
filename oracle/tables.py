"""DuckDB oracle: the metric tables, written from their definitions.

Facts are one long list of events (keys, measure name, value) and one
conditional aggregate over it (``rollup``). Dimensions and worklists take each
figure with a subquery for the row at hand. The backlog counts, for every month
end, the findings open on that day. The Spark jobs share none of this text but
the raw bindings.
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-04'"
SPINE_FIRST = "DATE '1998-06-01'"
SPINE_LAST = "DATE '2001-05-01'"
NUM = "DECIMAL(18,9)"


def M(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def D(x: str) -> str:
    return f"CAST({x} AS DATE)"


def SD(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def last_year(x: str, bounded: bool = False) -> str:
    upper = f" AND {D(x)} <= {AS_OF}" if bounded else ""
    return f"({D(x)} > DATE '2000-06-04'{upper})"


def iff(cond: str, value: str = "1") -> str:
    return f"CASE WHEN {cond} THEN {value} ELSE 0 END"


def rollup(keys: str, parts: list[tuple[str, str, dict[str, str]]], strict: str | None = None,
           names: str = "facility_name region", may_lack: str = "") -> str:
    """One conditional aggregate over the events of all parts.

    A part is (source, key expressions, {measure: value of a row}). A row whose
    strict keys are not all there adds to no measure but has its key row. Names
    come from the facility of the key. A sum of nothing is 0, but for the
    measures in ``may_lack``.
    """
    events, measures = [], []
    key_list = keys.split()
    for source, exprs, values in parts:
        key_sql = ", ".join(f"{e} AS {k}" for e, k in zip(exprs.split("; "), key_list, strict=True))
        for name, value in values.items():
            measures.append(name)
            events.append(f"SELECT {key_sql}, '{name}' AS what, CAST({value} AS DECIMAL(38,11)) AS v FROM {source}")
    present = " AND ".join(f"{k} IS NOT NULL" for k in (keys if strict is None else strict).split()) or "true"
    one = {m: f"sum(v) FILTER (WHERE what = '{m}' AND {present})" for m in measures}
    sums = ",\n  ".join(f"{x if m in may_lack.split() else f'coalesce({x}, 0)'} AS {m}" for m, x in one.items())
    shown = "".join(f", (SELECT max(f.{n}) FROM facilities f WHERE f.facility_id = e.facility_id) AS {n}" for n in names.split())
    inner = " UNION ALL\n  ".join(events)
    return f"\nSELECT {', '.join(key_list)}{shown}, * EXCLUDE ({', '.join(key_list)})\nFROM (SELECT {', '.join(key_list)},\n  {sums}\nFROM (\n  {inner}) GROUP BY {', '.join(key_list)}) e"


def at(source: str, key: str = "encounter_id", other: str = "encounters") -> str:
    """Rows of a source with what their encounter (or patient) says."""
    return f"{source} s JOIN {other} o ON s.{key} = o.{key}"


# name -> (dependencies, body). Dependencies are raw bindings or other tables.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}

DENIED = "claim_status = 'DENIED'"
CLAIM_EVENTS = {
    "total_claims": "1", "total_billed": "total_billed_amount", "total_allowed": "total_allowed_amount",
    "total_paid": "total_paid_amount", "denied_claims": iff(DENIED), "denied_billed": iff(DENIED, "total_billed_amount"),
    "underpayment_dollars": iff("claim_status = 'PAID' AND total_paid_amount < 0.95 * total_allowed_amount",
                                "total_allowed_amount - total_paid_amount"),
    "timely_filing_at_risk": iff(
        f"{DENIED} AND coalesce(appeal_status, 'NOT_APPEALED') = 'NOT_APPEALED' AND EXISTS (SELECT 1 FROM payer_contracts k "
        f"WHERE k.contract_id = claims.contract_id AND {D('denial_datetime')} + k.appeal_window_days - {AS_OF} BETWEEN 0 AND 15)"),
}
APPEAL_EVENTS = {"appeals_decided": iff("outcome IN ('LOST', 'PARTIAL_WON', 'WON')"),
                 "appeals_won": iff("outcome LIKE '%WON'"), "recovered_amount": "recovered_amount"}
_revenue = [f"SELECT 'claim' AS src, {M('submission_datetime')} AS month, payer_id, contract_id, payer_name, '{m}' AS what, "
            f"CAST({v} AS DECIMAL(38,11)) AS v FROM claims" for m, v in CLAIM_EVENTS.items()]
_revenue += [f"SELECT 'appeal', {M('decision_datetime')}, payer_id, NULL, (SELECT max(p.payer_name) FROM payers p "
             f"WHERE p.payer_id = appeals_history.payer_id), '{m}', CAST({v} AS DECIMAL(38,11)) FROM appeals_history "
             "WHERE decision_datetime IS NOT NULL" for m, v in APPEAL_EVENTS.items()]
TABLES["fact_revenue_cycle_month"] = (("claims", "payer_contracts", "appeals_history", "payers"), f"""
SELECT month, payer_id, max(payer_name) AS payer_name, contract_id,
  {', '.join(f"CASE src WHEN '{s}' THEN sum(v) FILTER (WHERE what = '{m}') ELSE 0 END AS {m}"
             for s, ms in (('claim', CLAIM_EVENTS), ('appeal', APPEAL_EVENTS)) for m in ms)}
FROM ({' UNION ALL '.join(_revenue)}) GROUP BY src, month, payer_id, contract_id""")

COST = f"CAST(worked_hours AS {NUM}) * hourly_cost"
TABLES["fact_workforce_month"] = (("workforce_shifts", "facilities"), "\nSELECT * EXCLUDE (census), census / total_shifts "
                                  "AS avg_patient_census FROM (" + rollup("month facility_id associate_role", [
    ("workforce_shifts", f"{M('shift_date')}; facility_id; associate_role", {
        "total_shifts": "1", "agency_shifts": iff("is_agency"), "scheduled_hours": "scheduled_hours",
        "worked_hours": "worked_hours", "overtime_hours": "overtime_hours", "agency_hours": iff("is_agency", "worked_hours"),
        "total_labor_cost": COST, "agency_cost": iff("is_agency", COST), "employed_cost": iff("NOT is_agency", COST),
        "overtime_cost": f"CAST(overtime_hours AS {NUM}) * hourly_cost", "census": "patient_census"})], strict="") + ")")

INPATIENT = "encounter_type = 'IP'"
TABLES["fact_throughput_month"] = ((
    "encounters", "bed_management", "appointments_scheduling", "prior_authorizations", "referrals",
    "patient_master_index", "orders_raw", "facilities"), rollup("month facility_id", [
        ("encounters", f"{M('admission_datetime')}; facility_id", {
            "encounters": "1", "ip_discharges": iff(f"{INPATIENT} AND status = 'DISCHARGED'"),
            "ip_los_sum": iff(INPATIENT, "coalesce(los_days, 0)"),
            "los_excess_sum": iff("los_days > drg_benchmark_los", "los_days - drg_benchmark_los")}),
        ("bed_management", f"{M('assigned_datetime')}; facility_id", {
            "ed_boarding_sum": "coalesce(ed_boarding_hours, 0)", "ed_boarding_events": iff("ed_boarding_hours IS NOT NULL"),
            "blocked_bed_events": iff("is_blocked")}),
        ("appointments_scheduling", f"{M('scheduled_datetime')}; facility_id", {
            "appointments": "1", "no_shows": iff("status = 'NO_SHOW'"), "new_patient_appts": iff("is_new_patient")}),
        (at("prior_authorizations"), f"{M('s.requested_datetime')}; o.facility_id", {
            "prior_auths": "1", "pa_denied": iff("s.auth_status IN ('NOT_OBTAINED', 'DENIED')"),
            "pa_decided": iff("s.decision_datetime IS NOT NULL"),
            "pa_turnaround_hours_sum": "coalesce(datesub('hour', s.requested_datetime, s.decision_datetime), 0)"}),
        (at("referrals", "master_patient_id", "patient_master_index"), f"{M('s.created_date')}; o.primary_facility_id", {
            "referrals_made": "1", "referrals_out_of_network": iff("NOT s.is_in_network")}),
        (at("orders_raw"), f"{M('s.order_datetime')}; o.facility_id", {"imaging_orders": iff("s.order_type = 'IMAGING'")}),
    ]))

_REPEATED = ("(SELECT c.*, count(*) OVER (PARTITION BY encounter_id, cpt_code, billed_amount) AS lines FROM charges c "
             "WHERE status = 'POSTED')")
TABLES["fact_quality_month"] = ((
    "quality_safety_events", "cdi_queries", "charges", "claims", "care_management", "encounters", "facilities"),
    rollup("month facility_id", [
        ("quality_safety_events", f"{M('event_datetime')}; facility_id", {
            "safety_events": "1", "serious_safety_events": iff("severity IN ('DEATH', 'SEVERE')"),
            "readmissions_30d": iff("event_type = 'READMISSION_30D'"), "preventable_events": iff("is_preventable")}),
        (at("cdi_queries"), f"{M('s.created_datetime')}; o.facility_id", {
            "cdi_queries": "1", "cdi_responses": iff("s.query_status IN ('AGREED', 'ANSWERED', 'DISAGREED')"),
            "cdi_no_response": iff("s.query_status = 'NO_RESPONSE'"),
            "cdi_financial_impact": "coalesce(s.financial_impact, 0)"}),
        (at(_REPEATED) + " AND s.lines > 1", f"{M('s.charge_datetime')}; o.facility_id", {"duplicate_charge_lines": "1"}),
        (at("claims"), f"{M('s.submission_datetime')}; o.facility_id", {"co197_denials": iff("s.denial_code = 'CO-197'")}),
        (at("care_management"), f"{M('s.created_datetime')}; o.facility_id", {
            "snf_requests": iff("s.task_type = 'SNF_PLACEMENT_REQUEST'"),
            "snf_requests_not_started": iff("s.task_type = 'SNF_PLACEMENT_REQUEST' AND s.task_status = 'NOT_STARTED'")}),
    ]))

USED = "transaction_type IN ('ISSUE_TO_CASE', 'PO_RECEIPT')"
TABLES["fact_supply_month"] = (("supply_chain_transactions", "facilities"), rollup("month facility_id item_category", [
    ("supply_chain_transactions", f"{M('transaction_datetime')}; facility_id; item_category", {
        "txn_count": "1", "total_quantity": "quantity",
        "total_supply_cost": "CASE transaction_type WHEN 'ISSUE_TO_CASE' THEN extended_cost WHEN 'RETURN' THEN 0 - extended_cost ELSE 0 END",
        "waste_cost": iff("transaction_type = 'WASTE'", "extended_cost"),
        "off_contract_cost": iff(f"is_off_contract AND {USED}", "extended_cost"),
        "off_contract_txns": iff("is_off_contract")})], strict=""))

LAG = f"({D('s.charge_datetime')} - {D('o.admission_datetime')})"
TABLES["fact_charge_capture_day"] = (("charges", "claims", "encounters", "facilities"), rollup("day facility_id", [
    (at("charges"), f"{D('s.charge_datetime')}; o.facility_id", {
        "charges_posted": iff("s.status = 'POSTED'"), "charges_billed_amount": iff("s.status = 'POSTED'", "s.billed_amount"),
        "charge_lag_days_sum": iff("s.status = 'POSTED'", f"coalesce({LAG}, 0)"),
        "late_charges": iff(f"s.status = 'POSTED' AND {LAG} > 3")}),
    (at("claims"), f"{D('s.submission_datetime')}; o.facility_id", {
        "claims_submitted": "1", "claims_billed_amount": "s.total_billed_amount", "claims_paid_amount": "s.total_paid_amount"}),
]))


def total(fact: str, measure: str, period: str = "month") -> str:
    """A fact's measure in the month at hand; no month equals a missing one."""
    return f"(SELECT sum(x.{measure}) FROM {fact} x WHERE {M('x.' + period)} = m.month)"


_rcm, _wf, _tp, _cc = "fact_revenue_cycle_month", "fact_workforce_month", "fact_throughput_month", "fact_charge_capture_day"
_exec = {
    "rev": total(_rcm, "total_paid"), "total_billed": total(_rcm, "total_billed"), "denied": total(_rcm, "denied_claims"),
    "filed": total(_rcm, "total_claims"), "total_labor_cost": total(_wf, "total_labor_cost"),
    "total_supply_cost": total("fact_supply_month", "total_supply_cost"), "worked": total(_wf, "worked_hours"),
    "agency": total(_wf, "agency_hours"), "los": total(_tp, "ip_los_sum"), "left_ip": total(_tp, "ip_discharges"),
    "waited": total(_tp, "ed_boarding_sum"), "waits": total(_tp, "ed_boarding_events"), "encounters": total(_tp, "encounters"),
    "serious_safety_events": total("fact_quality_month", "serious_safety_events"),
    "cash": total(_cc, "claims_paid_amount", "day"), "asked": total(_cc, "claims_billed_amount", "day"),
}
TABLES["exec_kpi_month"] = ((_rcm, _wf, "fact_supply_month", _tp, "fact_quality_month", _cc), f"""
SELECT month, {SD('rev - total_labor_cost - total_supply_cost', 'rev')} AS operating_margin_proxy, rev AS net_patient_revenue,
  {SD('rev', 'total_billed')} AS net_realization_pct, {SD('denied', 'filed')} AS denial_rate,
  30.0 - 30.0 * coalesce({SD('cash', 'asked')}, 0) AS ar_days_proxy, {SD('agency', 'worked')} AS agency_pct,
  {SD('total_labor_cost', 'worked')} AS labor_cost_per_worked_hour, {SD('los', 'left_ip')} AS alos,
  {SD('waited', 'waits')} AS ed_boarding_avg, serious_safety_events,
  1000 * {SD('serious_safety_events', 'encounters')} AS serious_safety_rate_per_1k,
  total_billed, total_labor_cost, total_supply_cost, encounters
FROM (SELECT month, {', '.join(f'{sql} AS {name}' for name, sql in _exec.items())}
      FROM (SELECT DISTINCT month FROM {_rcm}) m)""")

_RECENT_CLAIMS = f"claims c WHERE {last_year('c.submission_datetime')}"
TABLES["dim_payer"] = (("payers", "payer_contracts", "claims"), f"""
SELECT payer_id, payer_name, payer_type, contract_versions, avg_baseline_multiplier, earliest_expiration,
  coalesce(t.n, 0) AS total_claims_ttm, {SD('t.denied', 't.n')} AS denial_rate_ttm,
  {SD('t.paid', 't.allowed')} AS contract_yield_ttm, t.billed AS billed_ttm, t.paid AS paid_ttm
FROM (SELECT p.*, (SELECT count(*) FROM payer_contracts k WHERE k.payer_id = p.payer_id) AS contract_versions,
        (SELECT avg(k.baseline_multiplier) FROM payer_contracts k WHERE k.payer_id = p.payer_id) AS avg_baseline_multiplier,
        (SELECT min(k.expiration_date) FROM payer_contracts k WHERE k.payer_id = p.payer_id) AS earliest_expiration
      FROM payers p)
LEFT JOIN (SELECT payer_id, count(*) AS n, count(*) FILTER (WHERE {DENIED}) AS denied, sum(total_billed_amount) AS billed,
             sum(total_allowed_amount) AS allowed, sum(total_paid_amount) AS paid
           FROM {_RECENT_CLAIMS} GROUP BY ALL) t USING (payer_id)""")

TABLES["dim_facility"] = (("facilities", "encounters"), f"""
SELECT facility_id, facility_name, region, primary_emr, bed_capacity, is_legacy,
  (SELECT count(*) FROM encounters e WHERE e.facility_id = f.facility_id AND {last_year('e.admission_datetime')}) AS encounters_ttm
FROM facilities f""")

_SEEN = f"encounters e WHERE e.attending_provider_npi = p.provider_npi"
_BILLED = (f"claims c, encounters e WHERE c.encounter_id = e.encounter_id AND e.attending_provider_npi = p.provider_npi "
           f"AND {last_year('c.submission_datetime')}")
TABLES["dim_provider"] = (("providers", "encounters", "claims"), f"""
SELECT provider_sk, provider_npi, provider_name_hash, specialty, department_id, primary_facility_id, credentialing_status,
  documentation_quality_flag, (SELECT count(*) FROM {_SEEN} AND {last_year('e.admission_datetime')}) AS encounters_ttm,
  (SELECT count(*) FROM {_BILLED}) AS claims_ttm, (SELECT sum(c.total_billed_amount) FROM {_BILLED}) AS billed_ttm
FROM providers p WHERE is_current""")

TABLES["dim_contract"] = (("payer_contracts", "payers", "claims"), f"""
SELECT contract_id, payer_id, (SELECT max(p.payer_name) FROM payers p WHERE p.payer_id = k.payer_id) AS payer_name,
  plan_subtype, reimbursement_methodology, baseline_multiplier, effective_date, expiration_date, appeal_window_days,
  timely_filing_days, expiration_date - {AS_OF} AS days_to_expiry,
  (SELECT count(*) FROM {_RECENT_CLAIMS} AND c.contract_id = k.contract_id) AS claims_ttm,
  (SELECT sum(c.total_billed_amount) FROM {_RECENT_CLAIMS} AND c.contract_id = k.contract_id) AS billed_ttm
FROM payer_contracts k""")

TABLES["worklist_underpayments"] = (("claims", "payer_contracts"), f"""
SELECT claim_id, payer_id, payer_name, contract_id,
  (SELECT max(k.plan_subtype) FROM payer_contracts k WHERE k.contract_id = claims.contract_id) AS plan_subtype,
  drg_code, cpt_code, service_date_start, total_billed_amount, total_allowed_amount, total_paid_amount,
  total_allowed_amount - total_paid_amount AS underpayment_variance,
  {SD('total_allowed_amount - total_paid_amount', 'total_allowed_amount')} AS underpayment_pct
FROM claims WHERE claim_status = 'PAID' AND total_paid_amount < 0.95 * total_allowed_amount""")

_OF_CONTRACT = "claims c WHERE c.contract_id = k.contract_id"
_TOO_LATE = f"{_OF_CONTRACT} AND c.service_date_start > k.expiration_date"
TABLES["worklist_expiring_contracts"] = (("payer_contracts", "payers", "claims"), f"""
SELECT * FROM (
  SELECT contract_id, payer_id, (SELECT max(p.payer_name) FROM payers p WHERE p.payer_id = k.payer_id) AS payer_name,
    plan_subtype, effective_date, expiration_date, expiration_date - {AS_OF} AS days_to_expiry,
    (SELECT count(c.claim_id) FROM {_OF_CONTRACT}) AS claims_total,
    (SELECT count(*) FROM {_TOO_LATE}) AS claims_after_expiry,
    coalesce((SELECT sum(c.total_billed_amount) FROM {_TOO_LATE}), 0) AS dollars_billed_after_expiry
  FROM payer_contracts k WHERE expiration_date <= {AS_OF} + 90)
WHERE days_to_expiry BETWEEN 0 AND 90 OR claims_after_expiry > 0""")

TABLES["worklist_empi_duplicate_pairs"] = (("patient_master_index",), """
SELECT x.master_patient_id AS master_patient_id_a, y.master_patient_id AS master_patient_id_b, name_hash,
  x.match_confidence_score AS confidence_a, y.match_confidence_score AS confidence_b,
  x.primary_facility_id AS facility_a, y.primary_facility_id AS facility_b,
  CASE WHEN x.match_confidence_score + y.match_confidence_score IS NOT NULL
       THEN least(x.match_confidence_score, y.match_confidence_score) END AS min_confidence
FROM patient_master_index x JOIN patient_master_index y USING (name_hash)
WHERE x.master_patient_id < y.master_patient_id
  AND (x.match_confidence_score < 0.85 OR y.match_confidence_score < 0.85)""")

TABLES["worklist_agency_conversion"] = (("workforce_shifts", "facilities"), f"""
SELECT s.*, f.facility_name, f.region,
  CAST(agency_cost AS DECIMAL(29,9)) - CAST(CAST(agency_hours AS DECIMAL(20,9)) * employed_rate AS DECIMAL(29,9)) AS fte_conversion_opportunity
FROM (SELECT facility_id, associate_role, count(*) AS agency_shifts, sum(worked_hours) AS agency_hours, sum({COST}) AS agency_cost,
        (SELECT CAST({SD(f"sum({COST.replace('worked_hours', 'w.worked_hours').replace('hourly_cost', 'w.hourly_cost')})",
                         f"sum(CAST(w.worked_hours AS {NUM}))")} AS {NUM})
         FROM workforce_shifts w WHERE NOT w.is_agency AND w.associate_role = a.associate_role
           AND {last_year('w.shift_date')}) AS employed_rate
      FROM workforce_shifts a WHERE is_agency AND {last_year('shift_date')}
      GROUP BY facility_id, associate_role HAVING sum(worked_hours) > 0) s
LEFT JOIN facilities f USING (facility_id)""")

STAY = f"datesub('day', admission_datetime, CAST({AS_OF} AS TIMESTAMP))"
TABLES["worklist_los_outliers"] = (("encounters", "care_management", "providers", "departments", "facilities"), f"""
SELECT encounter_id, facility_id, (SELECT max(f.facility_name) FROM facilities f WHERE f.facility_id = e.facility_id) AS facility_name,
  (SELECT max(d.service_line) FROM providers p JOIN departments d USING (department_id)
   WHERE p.is_current AND p.provider_npi = e.attending_provider_npi) AS service_line,
  drg_code, admission_datetime, drg_benchmark_los, {STAY} AS current_los_days, {STAY} - drg_benchmark_los AS excess_days,
  discharge_planning_status, EXISTS (SELECT 1 FROM care_management t WHERE t.encounter_id = e.encounter_id
    AND t.task_type = 'SNF_PLACEMENT_REQUEST' AND t.task_status <> 'NOT_STARTED') AS snf_request_started
FROM encounters e WHERE status IN ('PENDING_DISCHARGE', 'ACTIVE') AND {STAY} > drg_benchmark_los + 2""")

_SYSTEM_INCIDENTS = f"it_incidents i WHERE i.system_id = s.system_id AND {last_year('i.opened_at', True)}"
TABLES["dim_it_system"] = (("it_systems", "it_vendors", "it_cost_ledger", "it_incidents"), f"""
SELECT system_id, system_name, vendor_id, vendor_name, category, capability, criticality, hosting, emr_affinity,
  owning_facility_id, go_live_date, end_of_life_date, annual_cost, is_eol,
  CASE WHEN end_of_life_date IS NULL THEN 'NONE' WHEN is_eol THEN 'PAST_EOL' WHEN away <= 12 THEN '<=12M'
       WHEN away <= 24 THEN '<=24M' ELSE '>24M' END AS eol_horizon_band,
  peers AS capability_redundancy_count, peers > 1 AS is_redundant, run_cost_ttm,
  CASE WHEN run_cost_ttm < 1000000 THEN '<1M' WHEN run_cost_ttm <= 5000000 THEN '1-5M' ELSE '>5M' END AS run_cost_band,
  incident_count_ttm, sev1_count_ttm, is_tier1,
  CASE WHEN NOT coalesce(is_tier1, true) AND peers > 1 AND (is_eol OR run_cost_ttm > 5000000) THEN 'ELIMINATE'
       WHEN is_eol THEN 'MIGRATE' WHEN is_tier1 THEN 'INVEST' ELSE 'TOLERATE' END AS time_class
FROM (SELECT s.*, (SELECT max(v.vendor_name) FROM it_vendors v WHERE v.vendor_id = s.vendor_id) AS vendor_name,
        coalesce(end_of_life_date <= {AS_OF}, false) AS is_eol, criticality LIKE 'TIER1%' AS is_tier1,
        datediff('month', {AS_OF}, end_of_life_date) AS away,
        (SELECT count(*) FROM it_systems x WHERE coalesce(x.capability, '') = coalesce(s.capability, '')) AS peers,
        coalesce((SELECT sum(l.amount) FROM it_cost_ledger l
                  WHERE l.system_id = s.system_id AND {last_year('l.period', True)}), 0) AS run_cost_ttm,
        (SELECT count(*) FROM {_SYSTEM_INCIDENTS}) AS incident_count_ttm,
        (SELECT count(*) FROM {_SYSTEM_INCIDENTS} AND i.severity = 'SEV1') AS sev1_count_ttm
      FROM it_systems s)""")

_OPEN_ON = "it_vulnerabilities v WHERE v.asset_id = a.asset_id AND v.patched_date IS NULL"
TABLES["dim_it_asset"] = (("it_assets", "it_vulnerabilities", "facilities"), f"""
SELECT asset_id, asset_type, facility_id, f.region, f.is_legacy, department_id, system_id, vendor_id, os_family, os_version,
  is_end_of_life, last_patched_date, {AS_OF} - last_patched_date AS days_since_patch,
  CASE WHEN last_patched_date IS NULL THEN 'NEVER' WHEN {AS_OF} - last_patched_date > 90 THEN 'STALE'
       WHEN {AS_OF} - last_patched_date > 30 THEN 'AGING' ELSE 'CURRENT' END AS patch_currency_band,
  (SELECT count(*) FROM {_OPEN_ON}) AS open_findings,
  (SELECT count(*) FROM {_OPEN_ON} AND v.severity = 'CRITICAL') AS open_critical_findings,
  is_end_of_life OR {AS_OF} - last_patched_date > 90 AS refresh_due
FROM it_assets a LEFT JOIN facilities f USING (facility_id)""")

MINUTES = "duration_minutes"
TABLES["fact_it_incident_month"] = (("it_incidents",), rollup("month facility_id system_id", [
    ("it_incidents", f"{M('opened_at')}; facility_id; system_id", {
        "incident_count": "1", **{f"sev{i}_count": iff(f"severity = 'SEV{i}'") for i in (1, 2, 3, 4)},
        "resolved_count": iff("resolved_at IS NOT NULL"), "resolution_minutes_sum": iff("resolved_at IS NOT NULL", MINUTES),
        "downtime_minutes_sum": MINUTES, "clinical_downtime_minutes": iff("is_clinical_downtime", MINUTES),
        "clinical_downtime_count": iff("is_clinical_downtime"), "change_caused_count": iff("root_cause = 'CHANGE'"),
        "within_sla_count": iff(" OR ".join(f"(severity = 'SEV{i}' AND {MINUTES} <= {n})" for i, n in
                                            ((1, 240), (2, 480), (3, 1440), (4, 4320))))})],
    strict="", names="", may_lack="resolution_minutes_sum clinical_downtime_minutes"))

FIXED_DAYS = "CASE severity WHEN 'CRITICAL' THEN 7 WHEN 'HIGH' THEN 30 WHEN 'MEDIUM' THEN 90 END"
LATE = f"coalesce(patched_date - detected_date > {FIXED_DAYS}, sla_breached, false)"
_OF_KEY = "f.facility_id = g.facility_id AND f.severity = g.severity"


def _finding(what: str, when: str) -> str:
    return f"(SELECT {what} FROM finding f WHERE {_OF_KEY} AND {when})"


_closed = f"{M('f.patched_date')} = g.month"
_open = "f.detected_date <= last_day(g.month) AND coalesce(f.patched_date > last_day(g.month), true)"
TABLES["fact_it_security_month"] = (("it_vulnerabilities", "facilities"), f"""
WITH finding AS (SELECT *, {LATE} AS late FROM it_vulnerabilities WHERE facility_id IS NOT NULL AND severity IS NOT NULL),
g AS (SELECT CAST(unnest(generate_series({SPINE_FIRST}, {SPINE_LAST}, INTERVAL 1 MONTH)) AS DATE) AS month, facility_id, severity
      FROM (SELECT DISTINCT facility_id, severity FROM finding)),
n AS (SELECT g.*, {_finding('count(*)', M('f.detected_date') + ' = g.month')} AS new_findings,
        {_finding('count(*)', _closed)} AS closed, {_finding('sum(f.patched_date - f.detected_date)', _closed)} AS days,
        {_finding('count(*) FILTER (WHERE NOT f.late)', _closed)} AS in_time,
        {_finding('count(*) FILTER (WHERE f.late)', _closed)} AS too_late,
        {_finding('count(*)', _open)} AS open, {_finding('sum(last_day(g.month) - f.detected_date)', _open)} AS age FROM g)
SELECT month, facility_id, (SELECT max(facility_name) FROM facilities x WHERE x.facility_id = n.facility_id) AS facility_name,
  (SELECT max(region) FROM facilities x WHERE x.facility_id = n.facility_id) AS region, severity, new_findings,
  closed AS remediated_findings, closed AS remediated_count, coalesce(days, 0) AS remediation_days_sum,
  in_time AS within_sla_count, too_late AS sla_breached_count, open AS open_findings_eom,
  {iff("severity = 'CRITICAL'", 'open')} AS open_critical_eom, {iff("severity = 'HIGH'", 'open')} AS open_high_eom,
  coalesce(age, 0) AS exposure_age_days_sum FROM n""")

IDLE = "CAST(amount AS DOUBLE) * coalesce(cloud_idle_pct, 0)"
TABLES["fact_it_cost_month"] = (("it_cost_ledger", "it_systems", "it_vendors"), """
SELECT t.*, (SELECT max(s.system_name) FROM it_systems s WHERE s.system_id = t.system_id) AS system_name,
  (SELECT max(v.vendor_name) FROM it_vendors v WHERE v.vendor_id = t.vendor_id) AS vendor_name FROM (""" + rollup(
    "period facility_id system_id vendor_id cost_category", [
        ("it_cost_ledger", "period; facility_id; system_id; vendor_id; cost_category", {
            "total_cost": "amount",
            "run_cost": iff("cost_category IN ('CLOUD', 'LABOR', 'LICENSE', 'SUPPORT', 'TELECOM')", "amount"),
            "grow_cost": iff("cost_category = 'HARDWARE'", "amount"), "cloud_cost": iff("cost_category = 'CLOUD'", "amount"),
            "cloud_idle_cost": iff("cost_category = 'CLOUD'", IDLE), "license_cost": iff("cost_category = 'LICENSE'", "amount"),
            "cost_line_count": "1"})], strict="", names="") + ") t")

TABLES["fact_it_servicedesk_month"] = (("service_desk_tickets", "it_change_requests", "facilities"), rollup("month facility_id", [
    ("service_desk_tickets", f"{M('opened_at')}; facility_id", {
        "ticket_count": "1", "resolved_count": iff("resolved_at IS NOT NULL"),
        "resolution_minutes_sum": "coalesce(resolution_minutes, 0)", "self_service_count": iff("is_self_service"),
        "first_contact_count": iff("resolved_at IS NOT NULL AND NOT reopened"), "reopened_count": iff("reopened"),
        **{f"{c.replace('_', '').lower()}_count": iff(f"channel = '{c}'") for c in ("PHONE", "PORTAL", "SELF_SERVICE", "WALKUP")}}),
    ("it_change_requests", f"{M('coalesce(implemented_at, scheduled_at)')}; facility_id", {
        "change_total": "1", "change_success_count": iff("status = 'SUCCESS'"), "change_failed_count": iff("status <> 'SUCCESS'"),
        "change_caused_incident_count": iff("caused_incident"), "change_emergency_count": iff("change_type = 'EMERGENCY'"),
        "change_lead_time_minutes_sum": "coalesce(datesub('minute', scheduled_at, implemented_at), 0)"}),
], strict="month"))

_dex_keys = "period IS NOT NULL AND facility_id IS NOT NULL AND department_id IS NOT NULL"


def _dex(measure: str) -> str:
    return f"coalesce({measure} FILTER (WHERE {_dex_keys}), 0)"


TABLES["fact_it_dex_month"] = (("clinician_ehr_usage", "ai_tool_usage"), f"""
SELECT period, facility_id, department_id, {_dex('sum(total_ehr_minutes)')} AS total_ehr_minutes_sum,
  {_dex('sum(after_hours_minutes)')} AS after_hours_minutes_sum, {_dex('sum(inbasket_messages)')} AS inbasket_messages_sum,
  {_dex('sum(CAST(avg_login_seconds AS DECIMAL(18,9)))')} AS login_seconds_sum, {_dex('count(logins)')} AS login_observations,
  {_dex('count(DISTINCT clinician)')} AS active_providers, {_dex('sum(sessions)')} AS ai_sessions_sum,
  {_dex('sum(minutes_saved)')} AS ai_minutes_saved_sum, {_dex('sum(governed)')} AS governed_session_count,
  {_dex('count(DISTINCT adopter)')} AS adopting_provider_count
FROM (SELECT * REPLACE ({M('period')} AS period), 1 AS logins, provider_npi AS clinician FROM clinician_ehr_usage
      UNION ALL BY NAME
      SELECT * REPLACE ({M('period')} AS period), provider_npi AS adopter, {iff('is_governed', 'sessions')} AS governed
      FROM ai_tool_usage)
GROUP BY period, facility_id, department_id""")

DUE = "detected_date + CASE severity WHEN 'CRITICAL' THEN 7 ELSE 30 END"
TABLES["worklist_open_critical_vulns"] = (("it_vulnerabilities", "it_systems", "facilities"), f"""
SELECT finding_id, cve, severity, asset_id, v.system_id, s.system_name, v.facility_id, f.region, f.is_legacy, days_open,
  {DUE} AS sla_due_date, coalesce(sla_breached, false) OR {AS_OF} > {DUE} AS is_sla_breached,
  coalesce(starts_with(s.criticality, 'TIER1'), false) AS is_clinical_system,
  coalesce(days_open, 0) * CASE severity WHEN 'CRITICAL' THEN 10 ELSE 5 END AS exposure_score
FROM it_vulnerabilities v LEFT JOIN it_systems s USING (system_id) LEFT JOIN facilities f ON f.facility_id = v.facility_id
WHERE patched_date IS NULL AND severity IN ('HIGH', 'CRITICAL') AND (detected_date IS NOT NULL OR coalesce(sla_breached, false))""")

_SINCE = f"({AS_OF} - last_patched_date)"
TABLES["worklist_eol_refresh"] = (("it_assets", "it_systems", "it_vulnerabilities", "facilities"), f"""
SELECT i.* EXCLUDE (ended, stale), f.region, f.is_legacy,
  40 * ended + 30 * coalesce(hosts_clinical_system, false)::INT + 15 * coalesce(f.is_legacy, false)::INT
  + 5 * least(open_critical_findings, 5) + 5 * (stale > 90)::INT + 5 * (stale > 180)::INT
  + 10 * (coalesce(annual_run_cost, 0) > 1000000)::INT AS refresh_priority_score
FROM (SELECT 'ASSET' AS item_kind, asset_id AS item_id, asset_type AS label, facility_id, {_SINCE} AS days_past_eol,
        (SELECT count(*) FROM {_OPEN_ON} AND v.severity = 'CRITICAL') AS open_critical_findings,
        CAST(NULL AS DECIMAL(18,2)) AS annual_run_cost,
        EXISTS (SELECT 1 FROM it_systems s WHERE s.system_id = a.system_id AND s.criticality = 'TIER1_LIFE_SAFETY') AS hosts_clinical_system,
        coalesce(is_end_of_life, false)::INT AS ended, coalesce({_SINCE}, 0) AS stale
      FROM it_assets a WHERE coalesce(is_end_of_life, false) OR {_SINCE} > 90
      UNION ALL
      SELECT 'SYSTEM', system_id, capability, owning_facility_id, {AS_OF} - end_of_life_date, 0, annual_cost,
        criticality = 'TIER1_LIFE_SAFETY', 1, 0
      FROM it_systems WHERE end_of_life_date <= {AS_OF}) i
LEFT JOIN facilities f USING (facility_id)""")

TABLES["worklist_app_rationalization"] = (("dim_it_system",), """
SELECT system_id, system_name, capability, vendor_name, emr_affinity, capability_redundancy_count AS redundancy_count,
  better + 1 AS redundancy_rank, run_cost_ttm, CASE WHEN better > 0 THEN run_cost_ttm ELSE 0 END AS consolidatable_spend,
  time_class, CASE WHEN better > 0 THEN 'RETIRE' ELSE 'KEEP' END AS keep_or_retire
FROM (SELECT d.*, (SELECT count(*) FROM dim_it_system x WHERE x.is_redundant AND x.run_cost_ttm > d.run_cost_ttm
                   AND coalesce(x.capability, '') = coalesce(d.capability, '')) AS better
      FROM dim_it_system d WHERE is_redundant)""")

TABLES["worklist_cloud_waste"] = (("it_cost_ledger", "it_systems", "it_vendors"), f"""
SELECT cost_id, l.system_id, s.system_name, (SELECT max(v.vendor_name) FROM it_vendors v WHERE v.vendor_id = l.vendor_id) AS vendor_name,
  facility_id, period, amount AS cloud_cost, cloud_idle_pct, {IDLE} AS monthly_idle_amount, 12 * {IDLE} AS annualized_savings,
  s.owning_facility_id AS owner_facility
FROM it_cost_ledger l LEFT JOIN it_systems s USING (system_id)
WHERE cost_category = 'CLOUD' AND cloud_idle_pct >= 0.20 AND period >= DATE '2001-03-04'""")

TABLES["worklist_vendor_renewals"] = (("it_vendors", "it_systems", "it_cost_ledger"), f"""
SELECT DISTINCT vendor_id, vendor_name, category, is_strategic, msa_renewal_date, msa_renewal_date - {AS_OF} AS days_to_renewal,
  annual_spend, coalesce((SELECT sum(l.amount) FROM it_cost_ledger l
    WHERE l.vendor_id = v.vendor_id AND {last_year('l.period', True)}), 0) AS ttm_spend,
  (SELECT count(*) FROM it_systems s WHERE s.vendor_id = v.vendor_id) AS systems_under_vendor,
  is_strategic AND (SELECT count(*) FROM it_systems s WHERE s.vendor_id = v.vendor_id) > 1 AS is_sole_source
FROM it_vendors v WHERE msa_renewal_date BETWEEN {AS_OF} AND {AS_OF} + 180""")

_inc, _sec, _cost, _desk, _use = ("fact_it_incident_month", "fact_it_security_month", "fact_it_cost_month",
                                  "fact_it_servicedesk_month", "fact_it_dex_month")


def share(fact: str, a: str, b: str, period: str = "month") -> str:
    return SD(total(fact, a, period), total(fact, b, period))


TABLES["exec_it_kpi_month"] = ((_inc, _sec, _cost, _desk, _use, "dim_it_system"), f"""
SELECT month, 1 - {SD(total(_inc, 'downtime_minutes_sum'), '(SELECT count(*) FROM dim_it_system) * day(last_day(month)) * 1440')} AS service_availability_pct,
  coalesce({total(_inc, 'sev1_count')}, 0) AS major_incident_count,
  {share(_inc, 'resolution_minutes_sum', 'resolved_count')} AS mttr_minutes,
  {share(_inc, 'within_sla_count', 'incident_count')} AS incident_sla_pct,
  coalesce({total(_inc, 'clinical_downtime_minutes')}, 0) AS clinical_downtime_minutes,
  {share(_desk, 'change_success_count', 'change_total')} AS change_success_rate,
  {share(_desk, 'change_failed_count', 'change_total')} AS change_failure_rate,
  {share(_desk, 'change_emergency_count', 'change_total')} AS change_emergency_pct,
  {share(_desk, 'change_lead_time_minutes_sum', 'change_total')} / 60 AS change_lead_time_hours,
  coalesce({total(_sec, 'open_critical_eom')}, 0) AS open_critical_vulns,
  {SD(total(_sec, 'sla_breached_count'), f"({total(_sec, 'within_sla_count')} + {total(_sec, 'sla_breached_count')})")} AS vuln_sla_breach_pct,
  coalesce({total(_cost, 'total_cost', 'period')}, 0) AS it_spend_total,
  {share(_cost, 'run_cost', 'total_cost', 'period')} AS run_cost_pct,
  {share(_cost, 'cloud_idle_cost', 'cloud_cost', 'period')} AS cloud_idle_pct,
  {share(_desk, 'resolution_minutes_sum', 'resolved_count')} / 60 AS service_desk_mttr_hours,
  {share(_desk, 'self_service_count', 'ticket_count')} AS self_service_deflection_pct,
  {share(_desk, 'reopened_count', 'resolved_count')} AS reopen_rate,
  {share(_use, 'after_hours_minutes_sum', 'total_ehr_minutes_sum', 'period')} AS ehr_after_hours_pct,
  coalesce({total(_use, 'ai_minutes_saved_sum', 'period')}, 0) AS ai_minutes_saved,
  {share(_use, 'adopting_provider_count', 'active_providers', 'period')} AS ai_adoption_pct
FROM (SELECT CAST(unnest(generate_series({SPINE_FIRST}, {SPINE_LAST}, INTERVAL 1 MONTH)) AS DATE) AS month) m""")
