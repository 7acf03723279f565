"""The raw-table bindings give the same rows on Spark and DuckDB."""

import pytest

from metric_helpers import SF_SMALL, duck_rows, spark_rows
from strata.sources.testdata import BINDINGS, base_frames, binding_frame


@pytest.mark.parametrize("name", sorted(BINDINGS))
def test_binding_same_on_both_engines(spark, duck, name):
    s = spark_rows(binding_frame(spark, name, base_frames(spark, SF_SMALL)))
    d = duck_rows(duck, BINDINGS[name])
    assert len(s) > 0
    assert s == d
