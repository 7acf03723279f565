"""Union-then-aggregate spine equals the UNION DISTINCT + LEFT JOIN form (T7, T8)."""

from pyspark.sql import functions as F

from strata.operators.spine import conformed_rollup

A = [("m1", "f1", 1), ("m1", None, 2), (None, "f2", 3), ("m2", "f1", 4)]
B = [("m1", "f1", 10), ("m1", None, 20), ("m3", None, 30)]


def join_form(spark, null_safe_fac):
    spark.createDataFrame(A, "m string, f string, x int").createOrReplaceTempView("src_a")
    spark.createDataFrame(B, "m string, f string, y int").createOrReplaceTempView("src_b")
    eq = "<=>" if null_safe_fac else "="
    out = spark.sql(f"""
      with a as (select m, f, sum(x) x from src_a group by m, f),
           b as (select m, f, sum(y) y from src_b group by m, f),
           s as (select m, f from a union select m, f from b)
      select s.m, s.f, coalesce(a.x, 0) x, coalesce(b.y, 0) y from s
      left join a on s.m = a.m and s.f {eq} a.f
      left join b on s.m = b.m and s.f {eq} b.f""")
    return sorted((tuple(r) for r in out.collect()), key=_key)


def rollup_form(spark, null_safe_fac):
    a = spark.createDataFrame(A, "m string, f string, x int").withColumn("x", F.col("x").cast("bigint"))
    b = spark.createDataFrame(B, "m string, f string, y int").withColumn("y", F.col("y").cast("bigint"))
    zero = F.lit(0).cast("bigint")
    out = conformed_rollup([a, b], ["m", "f"], {"x": zero, "y": zero},
                           strict_keys=["m"] if null_safe_fac else None)
    return sorted((tuple(r) for r in out.collect()), key=_key)


def _key(t):
    return tuple("" if v is None else v for v in t)


def test_strict_keys(spark):
    assert sorted(join_form(spark, False), key=_key) == sorted(rollup_form(spark, False), key=_key)


def test_null_safe_facility(spark):
    assert sorted(join_form(spark, True), key=_key) == sorted(rollup_form(spark, True), key=_key)
