"""Operational facts (workforce, throughput, quality, supply, charge capture),
facility/provider dimensions and the operational worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (NUMERIC, as_numeric, as_of_lit, count_where, day_of, days_between, exact_sum, exact_sum_where, flag,
                         month_of, safe_ratio, sum_where, ttm_window, whole_units, zero_money)
from ..operators.dedupe import duplicate_line_counts
from ..operators.spine import conformed_rollup
from ..sources import RawTables
from .params import DEFAULT_AS_OF

# Fixed values of the operational rules.
LATE_CHARGE_DAYS = 3
LOS_OUTLIER_EXCESS_DAYS = 2
ACTIVE_STATUSES = ("ACTIVE", "PENDING_DISCHARGE")
SERIOUS_SEVERITIES = ("SEVERE", "DEATH")
CDI_RESPONSES = ("ANSWERED", "AGREED", "DISAGREED")
PA_DENIED_STATUSES = ("DENIED", "NOT_OBTAINED")
SNF_TASK = "SNF_PLACEMENT_REQUEST"



def _zero(kind: str):
    """Typed zero for a measure kind: i = count, d = double (added as decimals), m = money."""
    if kind == "i":
        return F.lit(0).cast("bigint")
    if kind == "d":
        return F.lit(0).cast(NUMERIC)
    return zero_money()


def _zeros(spec: dict[str, str]) -> dict:
    return {k: _zero(v) for k, v in spec.items()}


def _facility_attrs(raw: RawTables) -> DataFrame:
    return raw.facilities.select("facility_id", "facility_name", "region")


def _with_facility(df: DataFrame, raw: RawTables, cols: list[str]) -> DataFrame:
    """Attach facility name and region after aggregation (facility_id is the key)."""
    out = df.join(_facility_attrs(raw), "facility_id", "left")
    return out.select(*cols)


def _by_facility(raw: RawTables, rows: DataFrame, *extra: str) -> DataFrame:
    """Give rows the facility of their encounter.

    The rows meet their encounter as they are, in one shuffle; sums by (encounter, period)
    first would need a second one, as the join is by the encounter alone. The join splits
    the rows of a hot encounter (AQE).
    """
    bridge = raw.encounters.select("encounter_id", "facility_id", *extra)
    return rows.join(bridge, "encounter_id", "inner").drop("encounter_id")


def _one():
    return F.lit(1).cast("bigint")


def _count(cond):
    """1 where the predicate is TRUE, else 0, to be summed."""
    return flag(cond).cast("bigint")


# --------------------------------------------------------------------------- 02
def fact_workforce_month(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    w = raw.workforce_shifts
    cost = as_numeric("worked_hours") * F.col("hourly_cost")
    agg = w.groupBy(month_of("shift_date").alias("month"), "facility_id", "associate_role").agg(
        F.count(F.lit(1)).alias("total_shifts"),
        count_where(F.col("is_agency")).alias("agency_shifts"),
        exact_sum("scheduled_hours").alias("scheduled_hours"),
        exact_sum("worked_hours").alias("worked_hours"),
        exact_sum("overtime_hours").alias("overtime_hours"),
        exact_sum_where(F.col("is_agency"), "worked_hours").alias("agency_hours"),
        F.sum(cost).alias("total_labor_cost"),
        sum_where(F.col("is_agency"), cost, zero_money()).alias("agency_cost"),
        sum_where(~F.col("is_agency"), cost, zero_money()).alias("employed_cost"),
        F.sum(as_numeric("overtime_hours") * F.col("hourly_cost")).alias("overtime_cost"),
        F.avg("patient_census").alias("avg_patient_census"))
    return _with_facility(agg, raw, [
        "month", "facility_id", "facility_name", "region", "associate_role", "total_shifts",
        "agency_shifts", "scheduled_hours", "worked_hours", "overtime_hours", "agency_hours",
        "total_labor_cost", "agency_cost", "employed_cost", "overtime_cost", "avg_patient_census"])


# --------------------------------------------------------------------------- 03
THROUGHPUT_MEASURES = {
    "encounters": "i", "ip_discharges": "i", "ip_los_sum": "d", "los_excess_sum": "d",
    "ed_boarding_sum": "d", "ed_boarding_events": "i", "blocked_bed_events": "i",
    "appointments": "i", "no_shows": "i", "new_patient_appts": "i", "prior_auths": "i",
    "pa_denied": "i", "pa_decided": "i", "pa_turnaround_hours_sum": "i",
    "referrals_made": "i", "referrals_out_of_network": "i", "imaging_orders": "i",
}


def fact_throughput_month(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """month x facility throughput from six sources in one aggregation.

    Sources that reach a facility through their encounter or patient meet it row
    by row, in one shuffle each. Hours are added as decimals.
    """
    e = raw.encounters
    ip = F.col("encounter_type") == "IP"
    enc = e.select(
        month_of("admission_datetime").alias("month"), "facility_id",
        F.lit(1).cast("bigint").alias("encounters"),
        flag(ip & (F.col("status") == "DISCHARGED")).cast("bigint").alias("ip_discharges"),
        F.when(ip & F.col("los_days").isNotNull(), as_numeric("los_days")).otherwise(_zero("d")).alias("ip_los_sum"),
        F.when(F.col("los_days").isNotNull() & F.col("drg_benchmark_los").isNotNull(),
               F.greatest(as_numeric(F.col("los_days") - F.col("drg_benchmark_los")), _zero("d")))
        .otherwise(_zero("d")).alias("los_excess_sum"))
    b = raw.bed_management
    bed = b.select(
        month_of("assigned_datetime").alias("month"), "facility_id",
        F.coalesce(as_numeric("ed_boarding_hours"), _zero("d")).alias("ed_boarding_sum"),
        flag(F.col("ed_boarding_hours").isNotNull()).cast("bigint").alias("ed_boarding_events"),
        flag(F.col("is_blocked")).cast("bigint").alias("blocked_bed_events"))
    a = raw.appointments_scheduling
    appt = a.select(
        month_of("scheduled_datetime").alias("month"), "facility_id",
        F.lit(1).cast("bigint").alias("appointments"),
        flag(F.col("status") == "NO_SHOW").cast("bigint").alias("no_shows"),
        flag(F.col("is_new_patient")).cast("bigint").alias("new_patient_appts"))
    decided = F.col("decision_datetime").isNotNull()
    pa = _by_facility(raw, raw.prior_authorizations.select(
        "encounter_id", month_of("requested_datetime").alias("month"), _one().alias("prior_auths"),
        _count(F.col("auth_status").isin(*PA_DENIED_STATUSES)).alias("pa_denied"),
        _count(decided).alias("pa_decided"),
        F.when(decided, whole_units("HOUR", "requested_datetime", "decision_datetime")).otherwise(_zero("i"))
        .alias("pa_turnaround_hours_sum")))
    img = _by_facility(raw, raw.orders_raw.select(
        "encounter_id", month_of("order_datetime").alias("month"),
        _count(F.col("order_type") == "IMAGING").alias("imaging_orders")))
    ref = raw.referrals.select(
        "master_patient_id", month_of("created_date").alias("month"), _one().alias("referrals_made"),
        _count(~F.col("is_in_network")).alias("referrals_out_of_network"))
    ref = ref.join(raw.patient_master_index.select("master_patient_id", F.col("primary_facility_id").alias("facility_id")),
                   "master_patient_id", "inner").drop("master_patient_id")
    rolled = conformed_rollup([enc, bed, appt, pa, img, ref], ["month", "facility_id"], _zeros(THROUGHPUT_MEASURES))
    rolled = rolled.withColumns({m: F.col(m).cast("double") for m, kind in THROUGHPUT_MEASURES.items() if kind == "d"})
    return _with_facility(rolled, raw, ["month", "facility_id", "facility_name", "region",
                                        *THROUGHPUT_MEASURES])


# --------------------------------------------------------------------------- 04
QUALITY_MEASURES = {
    "safety_events": "i", "serious_safety_events": "i", "readmissions_30d": "i",
    "preventable_events": "i", "cdi_queries": "i", "cdi_responses": "i", "cdi_no_response": "i",
    "cdi_financial_impact": "m", "duplicate_charge_lines": "i", "co197_denials": "i",
    "snf_requests": "i", "snf_requests_not_started": "i",
}


def fact_quality_month(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    q = raw.quality_safety_events
    qse = q.select(
        month_of("event_datetime").alias("month"), "facility_id",
        F.lit(1).cast("bigint").alias("safety_events"),
        flag(F.col("severity").isin(*SERIOUS_SEVERITIES)).cast("bigint").alias("serious_safety_events"),
        flag(F.col("event_type") == "READMISSION_30D").cast("bigint").alias("readmissions_30d"),
        flag(F.col("is_preventable")).cast("bigint").alias("preventable_events"))
    status = F.col("query_status")
    cdi = _by_facility(raw, raw.cdi_queries.select(
        "encounter_id", month_of("created_datetime").alias("month"), _one().alias("cdi_queries"),
        _count(status.isin(*CDI_RESPONSES)).alias("cdi_responses"),
        _count(status == "NO_RESPONSE").alias("cdi_no_response"),
        F.col("financial_impact").alias("cdi_financial_impact")))
    posted = raw.charges.filter(F.col("status") == "POSTED")
    dup = _by_facility(raw, duplicate_line_counts(
        posted, ["encounter_id", "cpt_code", "billed_amount"], [month_of("charge_datetime").alias("month")],
        "duplicate_charge_lines").select("encounter_id", "month", "duplicate_charge_lines"))
    clm = _by_facility(raw, raw.claims.select(
        "encounter_id", month_of("submission_datetime").alias("month"),
        _count(F.col("denial_code") == "CO-197").alias("co197_denials")))
    snf = F.col("task_type") == SNF_TASK
    cm = _by_facility(raw, raw.care_management.select(
        "encounter_id", month_of("created_datetime").alias("month"), _count(snf).alias("snf_requests"),
        _count(snf & (F.col("task_status") == "NOT_STARTED")).alias("snf_requests_not_started")))
    rolled = conformed_rollup([qse, cdi, dup, clm, cm], ["month", "facility_id"], _zeros(QUALITY_MEASURES))
    return _with_facility(rolled, raw, ["month", "facility_id", "facility_name", "region", *QUALITY_MEASURES])


# --------------------------------------------------------------------------- 05
def fact_supply_month(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    s = raw.supply_chain_transactions
    t = F.col("transaction_type")
    cogs = (F.when(t == "ISSUE_TO_CASE", F.col("extended_cost"))
            .when(t == "RETURN", -F.col("extended_cost")).otherwise(zero_money()))
    agg = s.groupBy(month_of("transaction_datetime").alias("month"), "facility_id", "item_category").agg(
        F.count(F.lit(1)).alias("txn_count"),
        exact_sum("quantity").alias("total_quantity"),
        F.sum(cogs).alias("total_supply_cost"),
        sum_where(t == "WASTE", "extended_cost", zero_money()).alias("waste_cost"),
        sum_where(F.col("is_off_contract") & t.isin("PO_RECEIPT", "ISSUE_TO_CASE"),
                  "extended_cost", zero_money()).alias("off_contract_cost"),
        count_where(F.col("is_off_contract")).alias("off_contract_txns"))
    return _with_facility(agg, raw, [
        "month", "facility_id", "facility_name", "region", "item_category", "txn_count",
        "total_quantity", "total_supply_cost", "waste_cost", "off_contract_cost", "off_contract_txns"])


# --------------------------------------------------------------------------- 06
CAPTURE_MEASURES = {
    "charges_posted": "i", "charges_billed_amount": "m", "charge_lag_days_sum": "i",
    "late_charges": "i", "claims_submitted": "i", "claims_billed_amount": "m",
    "claims_paid_amount": "m",
}


def fact_charge_capture_day(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """day x facility charge capture and claim flow, each in one join by encounter."""
    posted = F.col("status") == "POSTED"
    ch = _by_facility(raw, raw.charges.select(
        "encounter_id", day_of("charge_datetime").alias("day"), _count(posted).alias("charges_posted"),
        F.when(posted, F.col("billed_amount")).otherwise(zero_money()).alias("charges_billed_amount")), "admission_datetime")
    lag = days_between("day", F.to_date("admission_datetime")).cast("bigint")
    ch = ch.select("day", "facility_id", "charges_posted", "charges_billed_amount",
                   (F.coalesce(lag, _zero("i")) * F.col("charges_posted")).alias("charge_lag_days_sum"),
                   F.when(lag > LATE_CHARGE_DAYS, F.col("charges_posted")).otherwise(_zero("i")).alias("late_charges"))
    cl = _by_facility(raw, raw.claims.select(
        "encounter_id", day_of("submission_datetime").alias("day"), _one().alias("claims_submitted"),
        F.col("total_billed_amount").alias("claims_billed_amount"),
        F.col("total_paid_amount").alias("claims_paid_amount")))
    rolled = conformed_rollup([ch, cl], ["day", "facility_id"], _zeros(CAPTURE_MEASURES))
    return _with_facility(rolled, raw, ["day", "facility_id", "facility_name", "region", *CAPTURE_MEASURES])


# --------------------------------------------------------------------------- 09
def dim_facility(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    enc = (raw.encounters.filter(ttm_window("admission_datetime", as_of))
           .groupBy("facility_id").agg(F.count(F.lit(1)).alias("encounters_ttm")))
    return (raw.facilities.join(enc, "facility_id", "left")
            .select("facility_id", "facility_name", "region", "primary_emr", "bed_capacity", "is_legacy",
                    F.coalesce("encounters_ttm", F.lit(0)).alias("encounters_ttm")))


# --------------------------------------------------------------------------- 10
def dim_provider(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    e = raw.encounters.filter(F.col("attending_provider_npi").isNotNull())
    enc = (e.filter(ttm_window("admission_datetime", as_of))
           .groupBy(F.col("attending_provider_npi").alias("provider_npi"))
           .agg(F.count(F.lit(1)).alias("encounters_ttm")))
    c = raw.claims.filter(ttm_window("submission_datetime", as_of)).select("encounter_id", "total_billed_amount")
    clm = (c.join(e.select("encounter_id", "attending_provider_npi"), "encounter_id", "inner")
           .groupBy(F.col("attending_provider_npi").alias("provider_npi"))
           .agg(F.count(F.lit(1)).alias("claims_ttm"), F.sum("total_billed_amount").alias("billed_ttm")))
    pr = raw.providers.filter(F.col("is_current"))
    return (pr.join(enc, "provider_npi", "left").join(clm, "provider_npi", "left")
            .select("provider_sk", "provider_npi", "provider_name_hash", "specialty", "department_id",
                    "primary_facility_id", "credentialing_status", "documentation_quality_flag",
                    F.coalesce("encounters_ttm", F.lit(0)).alias("encounters_ttm"),
                    F.coalesce("claims_ttm", F.lit(0)).alias("claims_ttm"), "billed_ttm"))


# --------------------------------------------------------------------------- 16
def worklist_agency_conversion(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Agency premium per facility x role against the role's employed hourly rate.

    One pass over the shifts gives agency and employed sums per facility and
    role; the role's rate is a window over those few rows. The rate is a ratio
    of sums as NUMERIC (nine fractional digits).
    """
    w = raw.workforce_shifts.filter(ttm_window("shift_date", as_of))
    hours = as_numeric("worked_hours")
    cost = hours * F.col("hourly_cost")
    agency = F.col("is_agency")
    agg = w.groupBy("facility_id", "associate_role").agg(
        exact_sum_where(agency, "worked_hours").alias("agency_hours"),
        sum_where(agency, cost, zero_money()).alias("agency_cost"),
        count_where(agency).alias("agency_shifts"),
        sum_where(~agency, cost, zero_money()).alias("_cost"),
        sum_where(~agency, hours, zero_money()).alias("_hours"))
    role = Window.partitionBy("associate_role")
    rated = agg.withColumn("employed_rate", as_numeric(safe_ratio(F.sum("_cost").over(role), F.sum("_hours").over(role))))
    out = rated.filter(F.col("agency_hours") > 0).join(_facility_attrs(raw), "facility_id", "left")
    wide = "decimal(29,9)"
    premium = F.col("agency_cost").cast(wide) - (F.col("agency_hours").cast(wide) * F.col("employed_rate")).cast(wide)
    return out.select(
        "facility_id", "facility_name", "region", "associate_role", "agency_shifts", "agency_hours",
        "agency_cost", "employed_rate", premium.alias("fte_conversion_opportunity"))


# --------------------------------------------------------------------------- 17
def worklist_los_outliers(raw: RawTables, as_of=DEFAULT_AS_OF) -> DataFrame:
    as_of_ts = as_of_lit(as_of).cast("timestamp_ntz")
    e = raw.encounters
    los = whole_units("DAY", "admission_datetime", as_of_ts)
    active = e.filter(F.col("status").isin(*ACTIVE_STATUSES)
                      & F.col("drg_benchmark_los").isNotNull()
                      & ((los - F.col("drg_benchmark_los")) > LOS_OUTLIER_EXCESS_DAYS))
    started = raw.care_management.filter((F.col("task_type") == SNF_TASK) & (F.col("task_status") != "NOT_STARTED"))
    snf = started.select("encounter_id").distinct().withColumn("snf_request_started", F.lit(True))
    pr = raw.providers.filter(F.col("is_current")).select(
        F.col("provider_npi").alias("attending_provider_npi"), "department_id")
    dept = raw.departments.select("department_id", "service_line")
    fac = raw.facilities.select("facility_id", "facility_name")
    # encounters without a provider are many: they match nothing, spread over keys of their own
    meets = F.coalesce("attending_provider_npi", F.concat(F.lit("\u0000"), "encounter_id"))
    out = (active.withColumn("_npi", meets).join(pr.withColumnRenamed("attending_provider_npi", "_npi"), "_npi", "left")
           .join(dept, "department_id", "left")
           .join(fac, "facility_id", "left")
           .join(snf, "encounter_id", "left"))
    return out.select(
        "encounter_id", "facility_id", "facility_name", "service_line", "drg_code", "admission_datetime",
        "drg_benchmark_los", los.alias("current_los_days"),
        (los - F.col("drg_benchmark_los")).alias("excess_days"),
        "discharge_planning_status",
        F.coalesce(F.col("snf_request_started"), F.lit(False)).alias("snf_request_started"))
