"""Read layer over the built tables: KPI reads, read-time ratios, ranked
worklist reads (every row with its rank) and the IT layer checks.

Facts store additive measures only, so every ratio here is SUM/SUM over the
requested grain (never an average of stored ratios).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_in_month, safe_ratio
from ..operators.scoring import rank_within
from . import kpi
from .layer import IT_TABLES
from .patterns import PATTERNS

# Fixed value of the A/R proxy.
AR_DAYS_BASIS = 30.0


def _exec(layer) -> dict[str, DataFrame]:
    return {"exec_kpi_month": layer.input("exec_kpi_month"), "exec_it_kpi_month": layer.input("exec_it_kpi_month")}


def kpi_latest(layer) -> DataFrame:
    return kpi.kpi_latest(layer.spark, _exec(layer))


def kpi_trend(layer) -> DataFrame:
    return kpi.kpi_trend(layer.spark, _exec(layer))


def kpi_scorecard(layer) -> DataFrame:
    return kpi.kpi_scorecard(layer.spark, _exec(layer))


def ratio_rollup(fact: DataFrame, by: list[str], ratios: dict[str, tuple[str, str]],
                 show: tuple[str, ...] = ()) -> DataFrame:
    """Ratios of sums of a fact's measures over any of its dimensions.

    ``ratios`` maps a name to (numerator, denominator), each a measure or
    several joined by ``+``; ``show`` are sums to return as well. The sums are
    taken first, so a ratio is never an average of stored ratios.
    """
    parts = [p for pair in ratios.values() for side in pair for p in side.split("+")]
    summed = fact.groupBy(*by).agg(*[F.sum(m).alias(m) for m in dict.fromkeys([*show, *parts])])

    def side(text: str):
        first, *rest = text.split("+")
        return reduce(lambda a, b: a + F.col(b), rest, F.col(first))
    return summed.select(*by, *show, *[safe_ratio(side(a), side(b)).alias(n) for n, (a, b) in ratios.items()])


# The ratios read from each fact.
REVENUE = {"denial_rate": ("denied_claims", "total_claims"), "win_rate": ("appeals_won", "appeals_decided")}
LABOR = {"agency_pct": ("agency_hours", "worked_hours"), "cost_per_worked_hour": ("total_labor_cost", "worked_hours"),
         "ot_pct": ("overtime_hours", "worked_hours")}
INCIDENTS = {"mttr_minutes": ("resolution_minutes_sum", "resolved_count"),
             "pct_within_sla": ("within_sla_count", "incident_count"),
             "pct_clinical": ("clinical_downtime_count", "incident_count")}
SECURITY = {"vuln_sla_pct": ("within_sla_count", "within_sla_count+sla_breached_count"),
            "mean_remediation_days": ("remediation_days_sum", "remediated_count")}
DEX = {"mean_login_latency": ("login_seconds_sum", "login_observations"),
       "governed_share": ("governed_session_count", "ai_sessions_sum")}
CLAIMS = ("total_claims", "denied_claims", "appeals_decided", "appeals_won")
HOURS = ("worked_hours", "agency_hours", "overtime_hours", "total_labor_cost")


def _ratios(table: str, by: list[str], ratios: dict, show: tuple[str, ...] = ()):
    def read(layer) -> DataFrame:
        return ratio_rollup(layer.input(table), by, ratios, show)
    return read


payer_revenue_ratios = _ratios("fact_revenue_cycle_month", ["payer_id"], REVENUE, CLAIMS)
payer_month_revenue_ratios = _ratios("fact_revenue_cycle_month", ["payer_id", "month"], REVENUE, CLAIMS)
facility_labor_ratios = _ratios("fact_workforce_month", ["facility_id"], LABOR, HOURS)
region_month_labor_ratios = _ratios("fact_workforce_month", ["region", "month"], LABOR, HOURS)
incident_ratios = _ratios("fact_it_incident_month", ["system_id"], INCIDENTS, ("incident_count",))
security_ratios = _ratios("fact_it_security_month", ["facility_id", "severity"], SECURITY, ("remediated_count",))
cloud_waste_pct = _ratios("fact_it_cost_month", ["system_id"], {"cloud_waste_pct": ("cloud_idle_cost", "cloud_cost")},
                          ("cloud_cost", "cloud_idle_cost"))
change_lead_time = _ratios("fact_it_servicedesk_month", ["month"],
                           {"avg_change_lead_minutes": ("change_lead_time_minutes_sum", "change_total")},
                           ("change_total",))
dex_ratios = _ratios("fact_it_dex_month", ["facility_id"], DEX)


def bed_occupancy(layer) -> DataFrame:
    """Inpatient bed-days over bed capacity x days in the month, per facility-month."""
    t = layer.input("fact_throughput_month").select("month", "facility_id", "ip_los_sum")
    d = layer.input("dim_facility").select("facility_id", "bed_capacity")
    out = t.join(d, "facility_id", "inner")
    return out.select("month", "facility_id", "ip_los_sum", "bed_capacity",
                      safe_ratio("ip_los_sum", F.col("bed_capacity") * days_in_month("month")).alias("bed_occupancy"))


def ar_days_daily(layer) -> DataFrame:
    """Daily cash-velocity proxy: 30 x (1 - paid / billed) over the day's claim flow."""
    flow = ratio_rollup(layer.input("fact_charge_capture_day"), ["day"],
                        {"_collected": ("claims_paid_amount", "claims_billed_amount")},
                        ("claims_billed_amount", "claims_paid_amount"))
    return flow.withColumn("ar_days_proxy", F.lit(AR_DAYS_BASIS) * (1 - F.coalesce("_collected", F.lit(0.0)))).drop(
        "_collected")


def top_underpayments(layer) -> DataFrame:
    """All underpaid claims with their rank, largest variance first."""
    return rank_within(layer.input("worklist_underpayments"), [], "underpayment_variance", "rank")


def top_cloud_waste(layer) -> DataFrame:
    """All idle cloud lines with their rank, largest savings first."""
    return rank_within(layer.input("worklist_cloud_waste"), [], "annualized_savings", "rank")


def ranked_eol_refresh(layer) -> DataFrame:
    return rank_within(layer.input("worklist_eol_refresh"), [], "refresh_priority_score", "rank")


def ranked_open_vulns(layer) -> DataFrame:
    return rank_within(layer.input("worklist_open_critical_vulns"), [], "exposure_score", "rank")


def ranked_duplicate_pairs(layer) -> DataFrame:
    """All duplicate-patient pairs with their rank, least confident first."""
    return rank_within(layer.input("worklist_empi_duplicate_pairs"), [], "min_confidence", "rank", descending=False)


def kpi_trend_latest(layer) -> DataFrame:
    return kpi.kpi_trend(layer.spark, _exec(layer), latest=True)


def check_it_nonempty(layer) -> DataFrame:
    """Row count of every IT metric table, with the table's place by name."""
    parts = [layer.input(t).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(t).alias("t"), F.lit(sorted(IT_TABLES).index(t) + 1).alias("place"), "n") for t in IT_TABLES]
    return reduce(DataFrame.unionByName, parts)


def check_exec_it(layer) -> DataFrame:
    e = layer.input("exec_it_kpi_month")
    return e.agg(F.count(F.lit(1)).alias("months"),
                 F.count_if(F.col("change_failure_rate").isNull()).alias("null_cfr"),
                 F.round(F.avg("service_availability_pct"), 4).alias("avg_avail"))


READS = {
    "kpi_latest": kpi_latest,
    "kpi_trend": kpi_trend,
    "kpi_scorecard": kpi_scorecard,
    "payer_revenue_ratios": payer_revenue_ratios,
    "facility_labor_ratios": facility_labor_ratios,
    "bed_occupancy": bed_occupancy,
    "ar_days_daily": ar_days_daily,
    "incident_ratios": incident_ratios,
    "security_ratios": security_ratios,
    "cloud_waste_pct": cloud_waste_pct,
    "change_lead_time": change_lead_time,
    "dex_ratios": dex_ratios,
    "top_underpayments": top_underpayments,
    "top_cloud_waste": top_cloud_waste,
    "payer_month_revenue_ratios": payer_month_revenue_ratios,
    "region_month_labor_ratios": region_month_labor_ratios,
    "ranked_eol_refresh": ranked_eol_refresh,
    "ranked_open_vulns": ranked_open_vulns,
    "ranked_duplicate_pairs": ranked_duplicate_pairs,
    "kpi_trend_latest": kpi_trend_latest,
    "check_it_nonempty": check_it_nonempty,
    "check_exec_it": check_exec_it,
    **PATTERNS,
}
NO_ORACLE: set[str] = set()
