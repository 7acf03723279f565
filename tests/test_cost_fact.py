"""The cost fact: what it shuffles, and its values on odd rows."""

import datetime as dt
from decimal import Decimal

import __spark_entry__ as entry

from metric_helpers import SF_SMALL
from test_shuffles import Raw, _exchanges

from strata.plans import it

QUERIES = entry.queries()


def test_cost_lines_are_not_summed_before_their_shuffle(spark):
    found, plan = _exchanges(spark, lambda: QUERIES["fact_it_cost_month"](spark, SF_SMALL))
    assert [how for keys, how in found if keys[0] == "period"] == ["REPARTITION_BY_NUM"]
    sums = [i for i, x in enumerate(plan.splitlines()) if "HashAggregate(keys=[period" in x]
    dealt = next(i for i, x in enumerate(plan.splitlines()) if "REPARTITION_BY_NUM" in x)
    assert sums and max(sums) < dealt


def test_cost_by_category_on_odd_rows(spark):
    day = dt.date(2001, 1, 1)
    rows = [(day, "F1", "S1", "V1", "CLOUD", Decimal("10.00"), 0.5), (day, "F1", "S1", "V1", "CLOUD", Decimal("2.00"), None),
            (day, "F1", "S1", "V1", "CLOUD", None, 0.5), (day, "F1", "S1", "V1", "HARDWARE", Decimal("3.00"), 0.5),
            (day, "F1", "S1", "V1", "LICENSE", None, None), (None, None, None, None, None, Decimal("7.00"), 0.1)]
    ledger = spark.createDataFrame(rows, "period date, facility_id string, system_id string, vendor_id string, "
                                         "cost_category string, amount decimal(18,2), cloud_idle_pct double")
    raw = Raw(it_cost_ledger=ledger, it_systems=spark.createDataFrame([("S1", "one")], "system_id string, system_name string"),
              it_vendors=spark.createDataFrame([("V1", "v")], "vendor_id string, vendor_name string"))
    names = ("total_cost", "run_cost", "grow_cost", "cloud_cost", "cloud_idle_cost", "license_cost", "cost_line_count")
    got = {r["cost_category"]: tuple(float(r[n]) for n in names) for r in it.fact_it_cost_month(raw).collect()}
    assert got == {"CLOUD": (12, 12, 0, 12, 5, 0, 3), "HARDWARE": (3, 0, 3, 0, 0, 0, 1), "LICENSE": (0, 0, 0, 0, 0, 0, 1),
                   None: (7, 0, 0, 0, 0, 0, 1)}
