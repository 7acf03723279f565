"""Warehouse-dialect semantics of the column helpers (traps T1-T6, T9)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (count_where, month_boundaries, month_of, safe_ratio, strict_least,
                              whole_units)


def test_safe_ratio_null_on_zero_or_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4), (None, 2)], "a int, b int")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got == [None, None, 0.75, None]


def test_month_boundaries_not_whole_months(spark):
    df = spark.createDataFrame([(dt.date(2001, 2, 1), dt.date(2001, 1, 31)),
                                (dt.date(2002, 6, 3), dt.date(2001, 6, 4)),
                                (dt.date(2001, 6, 4), dt.date(2001, 6, 4))], "a date, b date")
    assert [r[0] for r in df.select(month_boundaries("a", "b")).collect()] == [1, 12, 0]


def test_whole_units_truncate(spark):
    df = spark.sql("select timestamp_ntz'2001-01-01 00:00:00' s, timestamp_ntz'2001-01-01 01:59:59' e")
    assert df.select(whole_units("HOUR", "s", "e")).first()[0] == 1
    assert df.select(whole_units("DAY", "s", "e")).first()[0] == 0


def test_strict_least_null_if_any_null(spark):
    df = spark.createDataFrame([(0.5, None), (0.5, 0.7)], "a double, b double")
    assert [r[0] for r in df.select(strict_least("a", "b")).collect()] == [None, 0.5]


def test_count_where_ignores_null_predicate(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    assert df.agg(count_where(F.col("f"))).first()[0] == 1
    assert df.filter("false").agg(count_where(F.col("f"))).first()[0] == 0


def test_month_of_is_date(spark):
    df = spark.sql("select timestamp_ntz'2001-03-31 23:59:59' t")
    r = df.select(month_of("t").alias("m"))
    assert dict(r.dtypes)["m"] == "date"
    assert r.first()[0] == dt.date(2001, 3, 1)


def test_ttm_window_same_for_dates_and_timestamps(spark):
    import datetime as dt

    from strata.functions import ttm_window

    as_of = dt.date(2001, 3, 31)
    days = [dt.date(2000, 3, 30), dt.date(2000, 3, 31), dt.date(2000, 4, 1), dt.date(2001, 3, 31), dt.date(2001, 4, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date").selectExpr("d", "cast(d as timestamp_ntz) + interval 23 hours t")
    got_d = [r[0] for r in df.select(ttm_window("d", as_of, bounded=True)).collect()]
    got_t = [r[0] for r in df.select(ttm_window("t", as_of, bounded=True)).collect()]
    # DATE(x) > add_months(2001-03-31, -12) = 2000-03-31, and <= as_of
    assert got_d == got_t == [False, False, True, True, False]
