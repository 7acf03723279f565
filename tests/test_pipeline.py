"""Materialised pipeline and NDJSON landing."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from strata.pipeline import run
from strata.plans.contract import comparable
from strata.plans.layer import MetricLayer
from strata.sources import RawTables
from strata.sources.ndjson import land_raw
from strata.sources.testdata import BINDING_AS_OF

from metric_helpers import SF_SMALL


def test_materialised_exec_equals_lazy(spark):
    out = tempfile.mkdtemp(prefix="strata-pipe-")
    raw = RawTables.testdata(spark, SF_SMALL)
    run(spark, raw, out, BINDING_AS_OF, tables=["exec_kpi_month", "worklist_app_rationalization"])
    assert os.path.isdir(os.path.join(out, "fact_revenue_cycle_month"))
    # partitioned by month on disk
    assert any(d.startswith("month=") for d in os.listdir(os.path.join(out, "fact_revenue_cycle_month")))
    written = comparable(spark.read.parquet(os.path.join(out, "exec_kpi_month")))
    lazy = comparable(MetricLayer(raw, BINDING_AS_OF)["exec_kpi_month"])
    cols = sorted(lazy.columns)
    assert sorted(map(tuple, written.select(cols).collect()), key=str) == \
        sorted(map(tuple, lazy.select(cols).collect()), key=str)
    # known to the catalog by name
    layer = MetricLayer(raw, BINDING_AS_OF, store=out)
    layer.register("strata_test", ["exec_kpi_month", "dim_it_system"])
    assert spark.sql("SELECT count(*) FROM strata_test.exec_kpi_month").first()[0] == written.count()
    assert spark.sql("SELECT count(*) FROM strata_test.dim_it_system").first()[0] > 0
    spark.sql("DROP DATABASE strata_test CASCADE")


def test_null_month_has_no_measures(spark):
    row = MetricLayer(RawTables.testdata(spark, SF_SMALL), BINDING_AS_OF)["exec_kpi_month"].where("month is null").collect()
    assert len(row) == 1 and row[0]["net_patient_revenue"] is None and row[0]["denial_rate"] is None
    assert row[0]["ar_days_proxy"] == 30.0


def test_sums_do_not_depend_on_partitions(spark):
    from strata.plans.operations import fact_workforce_month

    raw = RawTables.testdata(spark, SF_SMALL)

    class Dealt:
        def __init__(self, n):
            self.n = n

        def __getattr__(self, name):
            return raw[name].repartition(self.n) if name == "workforce_shifts" else raw[name]
    a, b = (sorted(map(str, fact_workforce_month(Dealt(n)).collect())) for n in (2, 7))
    assert a == b


def test_hot_partition_value_is_split_over_writers(spark):
    from strata.sources.sinks import write_table

    out = tempfile.mkdtemp(prefix="strata-sink-")
    df = spark.range(200_000).select(F.lit("2001-01").alias("month"), (F.col("id") % 3).alias("k"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(df, out + "/t", "month", ("k",))
        write_table(df, out + "/u", None, ("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(out + "/t/month=2001-01") if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(out + "/t").count() == spark.read.parquet(out + "/u").count() == 200_000


def test_ndjson_landing_ignores_unknown_fields(spark):
    src = tempfile.mkdtemp(prefix="strata-nd-")
    dst = tempfile.mkdtemp(prefix="strata-raw-")
    rows = [{"payer_id": "Y1", "payer_name": "A", "payer_type": "MA", "extra": 1},
            {"payer_id": "Y2", "payer_name": "B"}]
    with open(os.path.join(src, "payers.ndjson"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    counts = land_raw(spark, src, dst, ["payers"])
    assert counts == {"payers": 2}
    df = spark.read.parquet(os.path.join(dst, "payers"))
    assert df.columns == ["payer_id", "payer_name", "payer_type"]
    assert df.filter(F.col("payer_type").isNull()).count() == 1


def test_gzip_is_read_and_a_broken_line_stops_the_load(spark):
    import gzip

    import pytest

    src = tempfile.mkdtemp(prefix="strata-gz-")
    dst = tempfile.mkdtemp(prefix="strata-raw-")
    good = "\n".join(json.dumps({"payer_id": f"Y{i}", "payer_name": "A", "payer_type": "MA"}) for i in range(5))
    with gzip.open(os.path.join(src, "payers.ndjson.gz"), "wt") as fh:
        fh.write(good)
    assert land_raw(spark, src, dst, ["payers"]) == {"payers": 5}
    with gzip.open(os.path.join(src, "payers.ndjson.gz"), "wt") as fh:
        fh.write(good + '\n{"payer_id": "Y9", ')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE|FAILFAST"):
        land_raw(spark, src, dst, ["payers"])
