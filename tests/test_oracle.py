"""Every registered query equals its independent DuckDB formulation (sf0.001)."""

import pytest

import __spark_entry__ as entry
from metric_helpers import SF_SMALL, duck_rows, spark_rows

from strata.plans.layer import BUILD_ORDER
from strata.plans.reads import READS

NAMES = [*BUILD_ORDER, *READS]
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(QUERIES) and set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s = spark_rows(df)
    d = duck_rows(duck, ORACLE[name])
    assert s == d


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "operating_margin_proxy" in df.columns
