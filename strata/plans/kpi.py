"""KPI semantic layer over the two executive tables.

One unpivot of each scorecard joined to the KPI definitions answers every
tile at once (latest value, trend, comparison, threshold status, target gap)
instead of one query per tile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


@dataclass(frozen=True)
class Kpi:
    key: str
    dashboard: str
    order: int
    table: str
    column: str
    direction: str          # higher / lower is better
    threshold_op: str
    threshold: float
    target: float | None
    comparison: str         # prior_period (1 month) / prior_year (12 months)
    fraction: bool          # stored as a fraction, displayed x100


EXEC = "Executive Scorecard"
TECH = "Technology Scorecard"

# The KPI definitions of the two scorecard dashboards, in
# dashboard order (key, dashboard, order, table, column, direction,
# threshold operator, threshold, target, comparison basis, fraction scale).
KPIS: tuple[Kpi, ...] = (
    Kpi("Operating Margin", EXEC, 1, "exec_kpi_month", "operating_margin_proxy", "higher", ">=", 0, 0, "prior_period", True),
    Kpi("Net Patient Revenue", EXEC, 2, "exec_kpi_month", "net_patient_revenue", "higher", ">", 0, None, "prior_year", False),
    Kpi("Net Revenue Realization", EXEC, 3, "exec_kpi_month", "net_realization_pct", "higher", ">=", 30, None, "prior_period", True),
    Kpi("Denial Rate", EXEC, 4, "exec_kpi_month", "denial_rate", "lower", "<", 5, 5, "prior_period", True),
    Kpi("Days in A/R", EXEC, 5, "exec_kpi_month", "ar_days_proxy", "lower", "<", 45, 40, "prior_period", False),
    Kpi("Agency Labor %", EXEC, 6, "exec_kpi_month", "agency_pct", "lower", "<", 10, 10, "prior_period", True),
    Kpi("Labor Cost per Worked Hour", EXEC, 7, "exec_kpi_month", "labor_cost_per_worked_hour", "lower", "<", 100, None, "prior_period", False),
    Kpi("Average Length of Stay", EXEC, 8, "exec_kpi_month", "alos", "lower", "<", 5, 4.5, "prior_period", False),
    Kpi("ED Boarding Hours", EXEC, 9, "exec_kpi_month", "ed_boarding_avg", "lower", "<", 4, 2, "prior_period", False),
    Kpi("Serious Safety Events", EXEC, 10, "exec_kpi_month", "serious_safety_events", "lower", "<", 5, 0, "prior_period", False),
    Kpi("Service Availability", TECH, 1, "exec_it_kpi_month", "service_availability_pct", "higher", ">=", 99.9, 99.9, "prior_period", True),
    Kpi("Major Incidents", TECH, 2, "exec_it_kpi_month", "major_incident_count", "lower", "<", 3, 0, "prior_period", False),
    Kpi("MTTR", TECH, 3, "exec_it_kpi_month", "mttr_minutes", "lower", "<", 120, 90, "prior_period", False),
    Kpi("Change Failure Rate", TECH, 4, "exec_it_kpi_month", "change_failure_rate", "lower", "<", 15, 15, "prior_period", True),
    Kpi("Change Lead Time", TECH, 5, "exec_it_kpi_month", "change_lead_time_hours", "lower", "<", 72, 48, "prior_period", False),
    Kpi("Open Critical Vulnerabilities", TECH, 6, "exec_it_kpi_month", "open_critical_vulns", "lower", "<", 25, 0, "prior_period", False),
    Kpi("Vulnerability SLA Breach %", TECH, 7, "exec_it_kpi_month", "vuln_sla_breach_pct", "lower", "<", 10, 5, "prior_period", True),
    Kpi("IT Spend", TECH, 8, "exec_it_kpi_month", "it_spend_total", "lower", "<", 20000000, None, "prior_year", False),
    Kpi("Cloud Idle %", TECH, 9, "exec_it_kpi_month", "cloud_idle_pct", "lower", "<", 20, 15, "prior_period", True),
    Kpi("Self-Service Deflection", TECH, 10, "exec_it_kpi_month", "self_service_deflection_pct", "higher", ">=", 35, 40, "prior_period", True),
    Kpi("EHR After-Hours %", TECH, 11, "exec_it_kpi_month", "ehr_after_hours_pct", "lower", "<", 10, 8, "prior_period", True),
    Kpi("AI Adoption", TECH, 12, "exec_it_kpi_month", "ai_adoption_pct", "higher", ">=", 40, 60, "prior_period", True),
)

TREND_POINTS = 13
COMPARISON_MONTHS = {"prior_period": 1, "prior_year": 12}

_CATALOG_SCHEMA = StructType([
    StructField("kpi", StringType(), False), StructField("dashboard", StringType(), False),
    StructField("display_order", IntegerType(), False), StructField("source_table", StringType(), False),
    StructField("value_column", StringType(), False), StructField("direction", StringType(), False),
    StructField("threshold_op", StringType(), False), StructField("threshold", DoubleType(), False),
    StructField("target", DoubleType(), True), StructField("comparison", StringType(), False),
    StructField("comparison_months", IntegerType(), False), StructField("scale", DoubleType(), False),
])


def catalog(spark: SparkSession) -> DataFrame:
    rows = [(k.key, k.dashboard, k.order, k.table, k.column, k.direction, k.threshold_op, float(k.threshold),
             None if k.target is None else float(k.target), k.comparison, COMPARISON_MONTHS[k.comparison],
             100.0 if k.fraction else 1.0) for k in KPIS]
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def kpi_values(exec_tables: dict[str, DataFrame]) -> DataFrame:
    """Long form (source_table, value_column, month, value) of both scorecards."""
    parts = []
    for table, df in exec_tables.items():
        cols = [k.column for k in KPIS if k.table == table]
        wide = df.select("month", *[F.col(c).cast("double").alias(c) for c in cols])
        long = wide.unpivot(["month"], cols, "value_column", "value")
        parts.append(long.withColumn("source_table", F.lit(table)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _with_latest(vals: DataFrame) -> DataFrame:
    """Tag each row with its table's latest month (one pass, no subquery)."""
    return vals.withColumn("_latest", F.max("month").over(Window.partitionBy("source_table")))


def kpi_latest(spark: SparkSession, exec_tables: dict[str, DataFrame]) -> DataFrame:
    """Each KPI's value in its table's latest month (WHERE month = MAX(month))."""
    vals = _with_latest(kpi_values(exec_tables)).filter(F.col("month") == F.col("_latest"))
    return (vals.join(F.broadcast(catalog(spark)), ["source_table", "value_column"], "inner")
            .select("kpi", "dashboard", "display_order", "month", "value"))


def kpi_trend(spark: SparkSession, exec_tables: dict[str, DataFrame], latest: bool = False) -> DataFrame:
    """(kpi, period, value) for the oldest 13 months of each table, as the
    definitions' ``ORDER BY month ASC LIMIT 13`` reads; ``latest=True`` gives
    the most recent 13 instead."""
    vals = kpi_values(exec_tables)
    order = F.col("month").desc() if latest else F.col("month").asc()
    w = Window.partitionBy("source_table", "value_column").orderBy(order)
    ranked = vals.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= TREND_POINTS)
    return (ranked.join(F.broadcast(catalog(spark)), ["source_table", "value_column"], "inner")
            .select("kpi", F.date_format("month", "yyyy-MM-dd").alias("period"), "value"))


def _status(display: F.Column) -> F.Column:
    op, thr = F.col("threshold_op"), F.col("threshold")
    ok = (F.when(op == ">=", display >= thr).when(op == ">", display > thr)
          .when(op == "<", display < thr).when(op == "<=", display <= thr))
    return F.when(display.isNull(), F.lit(None)).when(ok, "good").otherwise("bad")


def kpi_scorecard(spark: SparkSession, exec_tables: dict[str, DataFrame]) -> DataFrame:
    """Latest value per KPI with comparison, threshold status and target gap.

    The comparison value is the KPI at the calendar month one month (prior
    period) or twelve months (prior year) before the latest month; NULL when
    that month has no row. Display values scale fractions to percent first.
    One pass: rows are tagged with the latest month, then a per-KPI
    conditional aggregate picks the current and the comparison value.
    """
    vals = _with_latest(kpi_values(exec_tables)).join(
        F.broadcast(catalog(spark)), ["source_table", "value_column"], "inner")
    prior_month = F.add_months(F.col("_latest"), -F.col("comparison_months"))
    keys = ["kpi", "dashboard", "display_order", "direction", "threshold_op", "threshold", "target",
            "comparison", "scale"]
    out = vals.groupBy(*keys).agg(
        F.max("_latest").alias("month"),
        F.max(F.when(F.col("month") == F.col("_latest"), F.col("value"))).alias("value"),
        F.max(prior_month).alias("prior_month"),
        F.max(F.when(F.col("month") == prior_month, F.col("value"))).alias("prior_value"))
    display = F.col("value") * F.col("scale")
    delta = F.col("value") - F.col("prior_value")
    improving = F.when(F.col("direction") == "higher", delta > 0).otherwise(delta < 0)
    return out.select(
        "kpi", "dashboard", "display_order", "month", "value", display.alias("display_value"),
        "comparison", "prior_month", "prior_value", delta.alias("delta"),
        F.try_divide(delta, F.abs(F.col("prior_value"))).alias("delta_pct"),
        improving.alias("improving"), _status(display).alias("status"), "target",
        (display - F.col("target")).alias("target_gap"))
