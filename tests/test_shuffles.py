"""Facts over sources with an encounter: what they shuffle, and their values on odd rows."""

import datetime as dt
import re
from decimal import Decimal

import pytest

import __spark_entry__ as entry

from metric_helpers import SF_SMALL

from strata.plans import operations

QUERIES = entry.queries()


def _exchanges(spark, df):
    """Keys of the hash exchanges of a plan without broadcasts."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = df()
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    found = re.findall(r"Exchange hashpartitioning\((.*), \d+\), (\w+)", plan)
    return [([re.sub(r"#.*", "", k.strip()) for k in keys.split(",")], how) for keys, how in found], plan


@pytest.mark.parametrize("name, key", [("fact_charge_capture_day", "encounter_id"), ("fact_quality_month", "encounter_id"),
                                       ("fact_throughput_month", "encounter_id"), ("fact_throughput_month", "master_patient_id")])
def test_rows_meet_their_encounter_in_one_shuffle(spark, name, key):
    found, _ = _exchanges(spark, lambda: QUERIES[name](spark, SF_SMALL))
    by_key = [keys for keys, _ in found if keys[0] == key and "cpt_code" not in keys]
    assert by_key and all(keys == [key] for keys in by_key)


class Raw:
    def __init__(self, **frames):
        self.__dict__.update(frames)


def test_capture_on_odd_rows(spark):
    """A repeated encounter takes its lines twice, a line without a known one is left out; nulls add nothing."""
    t, late = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 9)
    charges = spark.createDataFrame([("E1", late, "POSTED", Decimal("4.00")), ("E1", late, "POSTED", None),
                                     ("E1", late, "VOIDED", Decimal("9.00")), ("E2", t, "POSTED", Decimal("1.00")),
                                     (None, t, "POSTED", Decimal("5.00")), ("E9", t, "POSTED", Decimal("5.00"))],
                                    "encounter_id string, charge_datetime timestamp_ntz, status string, billed_amount decimal(18,2)")
    claims = spark.createDataFrame([("E1", t, Decimal("8.00"), None), ("E3", None, Decimal("8.00"), Decimal("1.00"))],
                                   "encounter_id string, submission_datetime timestamp_ntz, total_billed_amount decimal(18,2), "
                                   "total_paid_amount decimal(18,2)")
    encounters = spark.createDataFrame([("E1", "F1", t), ("E2", "F2", None), ("E2", "F2", t), ("E3", "F1", t), (None, "F1", t)],
                                       "encounter_id string, facility_id string, admission_datetime timestamp_ntz")
    facilities = spark.createDataFrame([("F1", "one", "r"), ("F2", "two", "r")], "facility_id string, facility_name string, region string")
    out = operations.fact_charge_capture_day(Raw(charges=charges, claims=claims, encounters=encounters, facilities=facilities))
    got = {(r["day"], r["facility_id"]): tuple(float(r[m]) for m in operations.CAPTURE_MEASURES) for r in out.collect()}
    assert got == {(late.date(), "F1"): (2, 4, 16, 2, 0, 0, 0), (t.date(), "F1"): (0, 0, 0, 0, 1, 8, 0),
                   (t.date(), "F2"): (2, 2, 0, 0, 0, 0, 0), (None, "F1"): (0, 0, 0, 0, 0, 0, 0)}
