"""Scans over blocks equal plain windows, also for hot keys, nulls, NaN and ties."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.components import components, spread_join
from strata.operators.scan import BLOCK, ordered
from strata.operators.scoring import rank_within


def key(rows):
    return sorted(map(str, rows))


def rows_with_hot_key(spark, n=3000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") * 7919 % 1009).alias("t"), "id",
        F.when(F.col("id") % 5 > 0, (F.col("id") * 31 % 17) - 8).alias("v"))


def test_running_values_equal_windows(spark):
    df = rows_with_hot_key(spark)
    run = ordered(df, ["k"], ["t", "id"], blocks=13)
    hot = run.frame.where("k = 'hot'").groupBy(BLOCK).count().collect()
    assert len(hot) > 5 and max(r["count"] for r in hot) < 1000
    got = run.running(s=("sum", "v"), sb=("sum_before", "v"), lo=("min", "v"), hi=("max_before", "v"), la=("last", "v"))
    w = Window.partitionBy("k").orderBy("t", "id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.sum("v").over(upto).alias("s"), F.sum("v").over(before).alias("sb"), F.min("v").over(upto).alias("lo"),
                     F.max("v").over(before).alias("hi"), F.last("v", True).over(upto).alias("la"))
    cols = want.columns
    assert key(got.frame.select(cols).collect()) == key(want.select(cols).collect())
    plan = got.frame._jdf.queryExecution().optimizedPlan().toString()
    assert "partitionBy" not in plan or BLOCK in plan


def test_totals_and_inner_groups(spark):
    df = rows_with_hot_key(spark).withColumn("g", F.floor(F.col("t") / 300))
    run = ordered(df, ["k"], ["t", "id"], blocks=9).within("g")
    got = run.total(n=("sum", "v"), m=("max", "t")).running(c=("sum", "v")).frame
    w = Window.partitionBy("k", "g")
    want = df.select("*", F.sum("v").over(w).alias("n"), F.max("t").over(w).alias("m"),
                     F.sum("v").over(w.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    assert key(got.select(want.columns).collect()) == key(want.collect())


def test_rank_of_odd_values(spark):
    values = [5.0, math.nan, 1.0, 1e-15, 0.0, -0.0, -1e-15, None, math.inf, -math.inf, 1e-300, 5.0, None, math.nan, 0.5, 0.5000001]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values * 3)], "g int, v double")
    for keys in ([], ["g"]):
        for down in (True, False):
            order = F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_last()
            want = df.withColumn("r", F.rank().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))
            assert key(rank_within(df, keys, "v", "r", descending=down).collect()) == key(want.collect())


def test_close_values_share_the_work(spark):
    df = spark.range(4000).select((F.lit(0.5) + F.col("id") / 1e7).alias("v"))
    spread = ordered(df, [], [F.col("v").desc_nulls_last()], blocks=8).frame.groupBy(BLOCK).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 1200


def test_spread_join_equals_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 == 0, None).otherwise(
        (F.col("id") % 300).cast("string")).alias("k"), "id")
    table = rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = spread_join(rows, table.where("k <> '3'"), "k", "n", 5000)
    want = rows.join(table.where("k <> '3'").drop("n"), "k", "left").select("k", "id", "m")
    assert key(got.collect()) == key(want.collect())


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)]          # a chain of 300 links
    edges += [(f"s{i:04d}", "hub") for i in range(2000)]                  # a star
    edges += [("x", "y"), ("y", "x"), ("x", "x"), (None, "q"), ("z", "z")]
    df = spark.createDataFrame(edges, "a string, b string").repartition(5)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert {got[f"c{i:04d}"] for i in range(301)} == {"c0000"}
    assert {got[f"s{i:04d}"] for i in range(2000)} == {"hub"} and got["hub"] == "hub"
    assert got["x"] == got["y"] == "x" and "q" not in got and "z" not in got


def test_chained_scans_carry_from_the_edge_rows_alone(spark):
    df = rows_with_hot_key(spark).withColumn("k", F.concat("k", (F.col("id") % 50).cast("string")))
    run = ordered(df, ["k"], ["t", "id"], blocks=7).running(last=("max_before", "t"))
    run = run.with_columns({"new": F.when(F.col("last").isNull() | (F.col("t") > F.col("last") + 20), 1).otherwise(0)})
    edges, few = run._edges().count(), run._at_edges().count()
    assert edges <= 14 and few < df.count() / 2
    got = run.running(n=("sum", "new"))
    assert got.edges is run.edges  # found once
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert key(got.frame.select("id", "n").collect()) == key(run.frame.select("id", F.sum("new").over(w).alias("n")).collect())
    # the broadcast of what is carried comes from rows cut to the edge keys below every window
    plan = got._at_edges()._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = [i for i, x in enumerate(plan) if "Join LeftSemi" in x]
    assert semi and not any("Window [" in x and BLOCK in x.split("], [")[1] for i in semi for x in plan[i:i + 8])
