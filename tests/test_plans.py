"""Physical-plan guards: no pair-producing joins, single scans where promised."""

import pytest

import __spark_entry__ as entry

from metric_helpers import SF_SMALL

from strata.plans.layer import BUILD_ORDER
from strata.plans.reads import READS

NAMES = [*BUILD_ORDER, *READS]
QUERIES = entry.queries()


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_backlog_scans_findings_once(spark):
    plan = _plan(QUERIES["fact_it_security_month"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1


def test_throughput_single_final_aggregation(spark):
    plan = _plan(QUERIES["fact_throughput_month"](spark, SF_SMALL))
    # one aggregation over the union of all six sources
    assert plan.count("HashAggregate(keys=[month") == 2  # partial + final


def _final(plan):
    return plan.split("== Initial Plan ==")[0]


def test_revenue_fact_is_hash_aggregated(spark):
    plan = _final(_plan(QUERIES["fact_revenue_cycle_month"](spark, SF_SMALL)))
    # the name is a group key of the large pass; max(name) only sees its few rows
    large = [x for x in plan.splitlines() if "Aggregate(keys" in x and "sum(total_billed_amount" in x]
    assert large and all("HashAggregate" in x for x in large)


@pytest.mark.parametrize("name", ["exec_kpi_month", "exec_it_kpi_month", "worklist_app_rationalization", "kpi_latest"])
def test_derived_tables_read_the_stored_layer(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "metric-layer" in plan and "lineitem.parquet" not in plan and "orders.parquet" not in plan


@pytest.mark.parametrize("name", ["worklist_eol_refresh", "worklist_los_outliers"])
def test_only_matching_rows_reach_the_aggregate(spark, name):
    plan = _final(_plan(QUERIES[name](spark, SF_SMALL)))
    scan = next(x for x in plan.splitlines() if "lineitem.parquet" in x)
    assert "DataFilters: []" not in scan


def test_agency_conversion_scans_shifts_once(spark):
    assert _final(_plan(QUERIES["worklist_agency_conversion"](spark, SF_SMALL))).count("lineitem.parquet") == 1


def test_ranks_equal_the_window_and_split_hot_groups(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from strata.operators.scoring import rank_within

    df = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string"))
        .alias("g"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 37 % 500 - 100) / 4).cast("decimal(18,2)").alias("v"))
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    up = Window.partitionBy().orderBy(F.col("v").asc_nulls_last())

    def key(rows):
        return sorted(map(str, rows))
    assert key(rank_within(df, ["g"], "v", "r").collect()) == key(df.withColumn("r", F.rank().over(w).cast("bigint")).collect())
    assert key(rank_within(df, [], "v", "r", descending=False).collect()) == key(
        df.withColumn("r", F.rank().over(up).cast("bigint")).collect())


@pytest.mark.parametrize("name, table", [("fact_revenue_cycle_month", "lineitem"), ("worklist_los_outliers", "orders")])
def test_rows_without_a_key_need_no_second_scan(spark, name, table):
    plan = _final(_plan(QUERIES[name](spark, SF_SMALL)))
    scans = [x for x in plan.splitlines() if "FileScan" in x and f"{table}.parquet" in x]
    # the appeals of the revenue fact come from the orders, the attended tasks of the worklist from the lines
    assert len(scans) == 1


def test_quantity_does_not_depend_on_the_order_of_rows(spark):
    from pyspark.sql import functions as F

    from strata.plans.operations import fact_supply_month

    rows = [(f"{i}", 0.1 * (i % 7) + 1e-3 * i) for i in range(2000)]
    df = spark.createDataFrame(rows, "i string, quantity double").select(
        F.lit("F1").alias("facility_id"), F.lit("SUPPLY").alias("item_category"), F.lit("2001-01-05").cast("timestamp").alias(
            "transaction_datetime"), F.lit("WASTE").alias("transaction_type"), "quantity",
        F.lit(1).cast("decimal(18,2)").alias("extended_cost"), F.lit(False).alias("is_off_contract"), "i")
    fac = spark.createDataFrame([("F1", "A", "NE")], "facility_id string, facility_name string, region string")

    def total(order):
        raw = type("Raw", (), {"supply_chain_transactions": df.repartition(5, *order), "facilities": fac})()
        return fact_supply_month(raw).first()["total_quantity"]
    assert total(["i"]) == total(["quantity"]) == total([F.reverse("i")])
