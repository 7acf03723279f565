"""Bindings read whole source tables: rows and distinct keys grow with the scale factor."""

import pytest
from pyspark.sql import functions as F

from strata.sources.testdata import BINDINGS, base_frames, binding_frame

# Bindings over the fixed-size nation/region tables stay constant by design.
FIXED = {"facilities", "departments", "it_vendors"}
KEYS = {"appeals_history": "payer_id", "it_assets": "system_id", "it_incidents": "system_id",
        "clinician_ehr_usage": "provider_npi", "ai_tool_usage": "provider_npi", "patient_master_index": "name_hash",
        "cdi_queries": "encounter_id", "care_management": "encounter_id"}


def _sizes(spark, sf_dir):
    base = base_frames(spark, sf_dir)
    out = {}
    for n in BINDINGS:
        df = binding_frame(spark, n, base)
        out[n] = tuple(df.agg(F.count(F.lit(1)), F.count_distinct(KEYS[n]) if n in KEYS else F.lit(0)).first())
    return out


@pytest.mark.parametrize("big", ["/root/testdata/sf0.01"])
def test_bindings_scale_with_data(spark, big):
    small = _sizes(spark, "/root/testdata/sf0.001")
    large = _sizes(spark, big)
    for n in BINDINGS:
        if n in FIXED:
            assert small[n] == large[n]
        else:
            assert large[n][0] >= 5 * small[n][0], n
    for n in KEYS:
        assert large[n][1] >= 5 * small[n][1], n


def test_bindings_have_no_row_predicates():
    assert not any(" where " in f" {' '.join(text.split())} " for text in BINDINGS.values())


def test_session_views_are_left_alone(spark):
    spark.range(3).createOrReplaceTempView("lineitem")
    base = base_frames(spark, "/root/testdata/sf0.001")
    assert binding_frame(spark, "claims", base).count() > 3
    assert spark.table("lineitem").count() == 3
    spark.catalog.dropTempView("lineitem")
