"""Independent DuckDB oracle for every registered query.

``sql_for(name)`` returns one self-contained statement: the raw bindings it
needs and the metric tables it depends on as CTEs (dependency order), then a
final projection applying the result contract (integral numbers as BIGINT,
other numbers as DOUBLE rounded to 6 decimals).
"""

from __future__ import annotations

from strata.sources.testdata import BINDINGS

from .patterns import PATTERNS
from .reads import READS as PLAIN_READS
from .tables import TABLES

# Output columns per table that the contract casts: (integral, non-integral).
KINDS: dict[str, tuple[str, str]] = {
    "fact_revenue_cycle_month": (
        "total_claims denied_claims timely_filing_at_risk appeals_decided appeals_won",
        "total_billed total_allowed total_paid denied_billed underpayment_dollars recovered_amount"),
    "fact_workforce_month": (
        "total_shifts agency_shifts",
        "scheduled_hours worked_hours overtime_hours agency_hours total_labor_cost agency_cost employed_cost "
        "overtime_cost avg_patient_census"),
    "fact_throughput_month": (
        "encounters ip_discharges ed_boarding_events blocked_bed_events appointments no_shows new_patient_appts "
        "prior_auths pa_denied pa_decided pa_turnaround_hours_sum referrals_made referrals_out_of_network "
        "imaging_orders",
        "ip_los_sum los_excess_sum ed_boarding_sum"),
    "fact_quality_month": (
        "safety_events serious_safety_events readmissions_30d preventable_events cdi_queries cdi_responses "
        "cdi_no_response duplicate_charge_lines co197_denials snf_requests snf_requests_not_started",
        "cdi_financial_impact"),
    "fact_supply_month": ("txn_count off_contract_txns",
                          "total_quantity total_supply_cost waste_cost off_contract_cost"),
    "fact_charge_capture_day": ("charges_posted charge_lag_days_sum late_charges claims_submitted",
                                "charges_billed_amount claims_billed_amount claims_paid_amount"),
    "exec_kpi_month": (
        "serious_safety_events encounters",
        "operating_margin_proxy net_patient_revenue net_realization_pct denial_rate ar_days_proxy agency_pct "
        "labor_cost_per_worked_hour alos ed_boarding_avg serious_safety_rate_per_1k total_billed total_labor_cost "
        "total_supply_cost"),
    "dim_payer": ("contract_versions total_claims_ttm",
                  "avg_baseline_multiplier denial_rate_ttm contract_yield_ttm billed_ttm paid_ttm"),
    "dim_facility": ("bed_capacity encounters_ttm", ""),
    "dim_provider": ("encounters_ttm claims_ttm", "billed_ttm"),
    "dim_contract": ("appeal_window_days timely_filing_days days_to_expiry claims_ttm", "baseline_multiplier billed_ttm"),
    "worklist_underpayments": ("", "total_billed_amount total_allowed_amount total_paid_amount underpayment_variance "
                                   "underpayment_pct"),
    "worklist_expiring_contracts": ("days_to_expiry claims_total claims_after_expiry", "dollars_billed_after_expiry"),
    "worklist_empi_duplicate_pairs": ("", "confidence_a confidence_b min_confidence"),
    "worklist_agency_conversion": ("agency_shifts",
                                   "agency_hours agency_cost employed_rate fte_conversion_opportunity"),
    "worklist_los_outliers": ("current_los_days", "drg_benchmark_los excess_days"),
    "dim_it_system": ("capability_redundancy_count incident_count_ttm sev1_count_ttm", "annual_cost run_cost_ttm"),
    "dim_it_asset": ("days_since_patch open_findings open_critical_findings", ""),
    "exec_it_kpi_month": (
        "major_incident_count clinical_downtime_minutes open_critical_vulns ai_minutes_saved",
        "service_availability_pct mttr_minutes incident_sla_pct change_success_rate change_failure_rate "
        "change_emergency_pct change_lead_time_hours vuln_sla_breach_pct it_spend_total run_cost_pct cloud_idle_pct "
        "service_desk_mttr_hours self_service_deflection_pct reopen_rate ehr_after_hours_pct ai_adoption_pct"),
    "fact_it_incident_month": (
        "incident_count sev1_count sev2_count sev3_count sev4_count resolved_count resolution_minutes_sum "
        "downtime_minutes_sum clinical_downtime_minutes clinical_downtime_count change_caused_count within_sla_count",
        ""),
    "fact_it_security_month": (
        "new_findings remediated_findings remediated_count remediation_days_sum within_sla_count sla_breached_count "
        "open_findings_eom open_critical_eom open_high_eom exposure_age_days_sum", ""),
    "fact_it_cost_month": ("cost_line_count",
                           "total_cost run_cost grow_cost cloud_cost cloud_idle_cost license_cost"),
    "fact_it_servicedesk_month": (
        "ticket_count resolved_count resolution_minutes_sum self_service_count first_contact_count reopened_count "
        "phone_count portal_count selfservice_count walkup_count change_total change_success_count "
        "change_failed_count change_caused_incident_count change_emergency_count change_lead_time_minutes_sum", ""),
    "fact_it_dex_month": (
        "total_ehr_minutes_sum after_hours_minutes_sum inbasket_messages_sum login_observations active_providers "
        "ai_sessions_sum ai_minutes_saved_sum governed_session_count adopting_provider_count",
        "login_seconds_sum"),
    "worklist_open_critical_vulns": ("days_open exposure_score", ""),
    "worklist_eol_refresh": ("days_past_eol open_critical_findings refresh_priority_score", "annual_run_cost"),
    "worklist_app_rationalization": ("redundancy_count redundancy_rank", "run_cost_ttm consolidatable_spend"),
    "worklist_cloud_waste": ("", "cloud_cost cloud_idle_pct monthly_idle_amount annualized_savings"),
    "worklist_vendor_renewals": ("days_to_renewal systems_under_vendor", "annual_spend ttm_spend"),
}

READS = {**PLAIN_READS, **PATTERNS,
         "quality_month_bucketed": (("fact_quality_month",), "SELECT * FROM fact_quality_month", KINDS["fact_quality_month"])}


def _definition(name: str) -> tuple[tuple[str, ...], str]:
    if name in BINDINGS:
        return (), BINDINGS[name]
    if name in TABLES:
        return TABLES[name]
    if name in READS:
        deps, body, _ = READS[name]
        return deps, body
    raise KeyError(name)


def _ordered_deps(name: str) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        deps, _ = _definition(n)
        for d in deps:
            if d not in seen:
                visit(d)
        if n not in seen:
            seen.append(n)

    visit(name)
    return seen


def kinds(name: str) -> tuple[list[str], list[str]]:
    ints, reals = KINDS[name] if name in KINDS else READS[name][2]
    return ints.split(), reals.split()


def sql_for(name: str) -> str:
    ctes = [f"{n} AS ({_definition(n)[1]}\n)" for n in _ordered_deps(name)]
    ints, reals = kinds(name)
    repl = [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    repl += [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in reals]
    select = f"SELECT * REPLACE ({', '.join(repl)}) FROM {name}" if repl else f"SELECT * FROM {name}"
    return "WITH " + ",\n".join(ctes) + "\n" + select


def all_sql() -> dict[str, str]:
    return {n: sql_for(n) for n in list(TABLES) + [r for r in READS if r not in ("kpi_catalog", "kpi_values")]}
