"""Pattern reads on small fixtures: hot keys, ties, gaps, chains and empty strata."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle
from metric_helpers import duck_rows, spark_rows
from strata.plans import patterns
from strata.plans.contract import comparable
from strata.session import checkpoint_dir

T0 = dt.datetime(2001, 1, 1)


class Layer:
    """A layer over given frames."""

    def __init__(self, spark, as_of=dt.date(2001, 6, 4), **frames):
        self.spark, self.as_of, self.store = spark, as_of, None
        self.raw = type("Raw", (), frames)()


def run_oracle(name, **frames):
    con = duckdb.connect()
    for n, df in frames.items():
        con.register(f"{n}_v", df.toArrow())
        con.execute(f"CREATE TABLE {n} AS SELECT * FROM {n}_v")
    ints, reals = oracle.kinds(name)
    repl = [f"CAST({c} AS BIGINT) AS {c}" for c in ints] + [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in reals]
    return duck_rows(con, f"SELECT * REPLACE ({', '.join(repl)}) FROM ({oracle.PATTERNS[name][1]})")


def lines(spark, seed=1, n=900):
    rng = random.Random(seed)
    orders, charges = [], []
    for i in range(n):
        enc = "HOT" if rng.random() < 0.4 else f"E{rng.randrange(60)}"
        at = T0 + dt.timedelta(hours=rng.randrange(24 * 40))
        if rng.random() < 0.5:
            orders.append((enc if rng.random() < 0.98 else None, at, rng.choice(["LAB", "IMAGING"]), f"O{i}",
                           rng.choice(["COMPLETED"] * 4 + ["CANCELLED"]), at if rng.random() < 0.95 else None))
        else:
            charges.append((enc if rng.random() < 0.98 else None, at if rng.random() < 0.95 else None, rng.choice(["C1", "C2"]),
                            rng.choice(["POSTED"] * 4 + ["VOIDED"]), f"H{i}"))
    return {"orders_raw": spark.createDataFrame(orders, "encounter_id string, order_datetime timestamp_ntz, order_type string, "
                                                        "order_id string, status string, completion_datetime timestamp_ntz"),
            "charges": spark.createDataFrame(charges, "encounter_id string, charge_datetime timestamp_ntz, cpt_code string, "
                                                      "status string, charge_id string")}


@pytest.mark.parametrize("name", ["charge_gap", "duplicate_line_sessions"])
def test_hot_encounter_equals_the_line_by_line_oracle(spark, name):
    frames = lines(spark)
    got = comparable(patterns.PATTERNS[name](Layer(spark, **frames)))
    want = run_oracle(name, **frames)
    assert spark_rows(got) == want and len(want) > 300


def test_charges_are_used_once_and_never_for_later_orders(spark):
    def at(h):
        return T0 + dt.timedelta(hours=h)
    orders = [("E", at(h), "LAB", f"O{i}", "COMPLETED", at(h)) for i, h in enumerate([1, 2, 2, 9])]
    charges = [("E", at(0), "C", "POSTED", "H0"), ("E", at(2), "C", "POSTED", "H1"), ("E", at(3), "C", "VOIDED", "H2"),
               ("E", at(30), "C", "POSTED", "H3")]
    rows = patterns.charge_gap(Layer(
        spark, orders_raw=spark.createDataFrame(orders, lines(spark)["orders_raw"].schema),
        charges=spark.createDataFrame(charges, lines(spark)["charges"].schema))).collect()
    assert {r["order_id"]: (r["charge_id"], r["delay_days"]) for r in rows} == {
        "O0": ("H1", 0), "O1": ("H3", 1), "O2": (None, None), "O3": (None, None)}


def test_contract_versions_overlaps_gaps_and_a_hot_contract(spark):
    d = dt.date(2000, 1, 1)

    def day(n):
        return d + dt.timedelta(days=n)
    versions = [("K", 1, day(0), day(100), 1.0), ("K", 2, day(80), day(90), 1.1), ("K", 3, day(200), None, 1.2),
                ("K", 4, day(200), day(210), 1.3), ("L", 1, day(50), day(60), 1.0), ("N", 1, None, day(5), 1.0), (None, 1, day(0), None, 9.0)]
    claims = [(f"c{i}", "K", day(i - 5)) for i in range(230)]
    claims += [(f"h{i}", "K", day(i * 7 % 220)) for i in range(1500)]
    claims += [("l1", "L", day(0)), ("l2", "L", day(60)), ("l3", "L", day(61)), ("n", "N", day(1)), ("x", "X", day(1)), ("z", None, day(1)),
               ("w", "K", None)]
    frames = {"contract_amendments": spark.createDataFrame(
        versions, "contract_id string, version_no int, effective_date date, expiration_date date, baseline_multiplier double"),
        "claims": spark.createDataFrame(claims, "claim_id string, contract_id string, service_date_start date").repartition(4)}
    got = patterns.claim_contract_version(Layer(spark, **frames))
    by = {r["claim_id"]: (r["state"], r["version_no"], r["days_outside"]) for r in got.collect()}
    assert by["c4"] == ("NOT_YET", None, 1) and by["c5"] == ("VALID", 1, 0) and by["c85"] == ("VALID", 2, 0)
    assert by["c98"] == ("EXPIRED", 2, 3)  # the older version would still run, but is superseded
    assert by["c204"] == ("EXPIRED", 2, 109) and by["c205"] == ("VALID", 4, 0) and by["c216"] == ("EXPIRED", 4, 1)
    assert by["l1"] == ("NOT_YET", None, 50) and by["l2"] == ("VALID", 1, 0) and by["l3"] == ("EXPIRED", 1, 1)
    assert by["n"] == by["x"] == ("NO_VERSION", None, None) and by["z"] == ("NO_CONTRACT", None, None)
    assert by["w"] == ("NO_DATE", None, None) and len(by) == len(claims)
    assert spark_rows(comparable(got)) == run_oracle("claim_contract_version", **frames)


def test_fragments_by_chains_and_a_hot_identifier(spark):
    rows = [(f"M{i:04d}", f"e{i // 2}", f"c{(i + 1) // 2}", None, None) for i in range(60)]          # one chain of 60
    rows += [(f"N{i:04d}", None, None, "shared", ["a", f"l{i}"] if i % 2 else None) for i in range(400)]  # a hot identifier
    rows += [("P1", "x1", None, None, None), ("P2", None, "x1", None, None), ("Q", None, None, None, []), (None, "e0", None, None, None)]
    df = spark.createDataFrame(rows, "master_patient_id string, epic_mrn string, cerner_pid string, meditech_id string, "
                                     "legacy_mrn_list array<string>")
    by = {r["master_patient_id"]: tuple(r)[1:] for r in patterns.patient_fragments(Layer(spark, patient_master_index=df)).collect()}
    assert len(by) == 463
    assert {by[f"M{i:04d}"] for i in range(60)} == {("M0000", 60, 2, True)}
    assert {by[f"N{i:04d}"] for i in range(400)} == {("N0000", 400, 2, True)}
    assert by["P1"] == ("P1", 1, 1, False) and by["P2"] == ("P2", 1, 1, False) and by["Q"] == ("Q", 1, 0, False)


def test_benchmark_of_one_large_peer_group(spark):
    rng = random.Random(8)
    claims = [(f"E{rng.randrange(400)}", f"Y{rng.randrange(30)}", rng.choice(["DENIED", "PAID", "PAID"])) for _ in range(4000)]
    claims += [("E1", "Y99", "PAID"), ("E0", "Y50", "DENIED"), ("missing", "Y1", "DENIED")]
    frames = {"claims": spark.createDataFrame(claims, "encounter_id string, payer_id string, claim_status string"),
              "encounters": spark.createDataFrame([(f"E{i}", None if i % 50 == 49 else f"F{i % 25}") for i in range(400)],
                                                  "encounter_id string, facility_id string"),
              "payers": spark.createDataFrame([(f"Y{i}", "MA" if i else "Medicaid") for i in range(30)] + [("Y50", "Alone")],
                                              "payer_id string, payer_type string")}
    got = comparable(patterns.denial_benchmark(Layer(spark, **frames)))
    assert spark_rows(got) == run_oracle("denial_benchmark", **frames)
    assert [tuple(r) for r in got.where("payer_type = 'Alone'").select("peers", "q1", "median", "percent_rank").collect()] == [(1, 1.0, 1.0, 0.0)]


def test_lift_of_flags_with_empty_strata(spark):
    claims = [("E1", "Y1", "C1", "DENIED"), ("E1", "Y1", "C1", "PAID"), ("E2", "Y1", "C1", "DENIED"), ("E2", "Y2", None, "PAID"),
              ("E3", "Y3", "C9", "PAID"), ("E4", "Y1", "C1", "PAID")]
    frames = {"claims": spark.createDataFrame(claims, "encounter_id string, payer_id string, cpt_code string, claim_status string"),
              "encounters": spark.createDataFrame([("E1", "N1"), ("E2", "N2"), ("E3", "N3"), ("E4", None)],
                                                  "encounter_id string, attending_provider_npi string"),
              "providers": spark.createDataFrame([("N1", "HIGH_QUERY_RATE", True), ("N2", None, True), ("N3", "OTHER", True),
                                                  ("N1", None, False)], "provider_npi string, documentation_quality_flag string, is_current boolean")}
    got = comparable(patterns.denial_lift_by_flag(Layer(spark, **frames)))
    by = {r["flag"]: tuple(r)[1:] for r in got.collect()}
    assert by["HIGH_QUERY_RATE"] == (2, 1, 1.0, 1.0) and by["NONE"] == (2, 1, 0.5, 2.0)
    assert by["OTHER"] == (1, 0, 0.0, None) and by["UNKNOWN"] == (1, 0, 0.5, 0.0)
    assert spark_rows(got) == run_oracle("denial_lift_by_flag", **frames)


def test_knowledge_fades_by_half_in_a_half_life(spark):
    notes = [("a", "HIGH", dt.date(2000, 6, 3), ["CO-1", "CO-1"]), ("b", "MEDIUM", dt.date(2000, 12, 31), ["CO-1", "CO-2"]),
             ("c", "HIGH", dt.date(2002, 1, 1), ["CO-1"]), ("d", "HIGH", None, ["CO-1"]), ("e", None, dt.date(2000, 1, 1), ["CO-1"]),
             ("f", "STALE", dt.date(2001, 6, 1), None)]
    frames = {"tribal_knowledge_notes": spark.createDataFrame(
        notes, "note_id string, confidence string, last_referenced_date date, referenced_codes array<string>"),
        "denial_codex": spark.createDataFrame([("x", "CO-1")], "codex_id string, denial_code string")}
    got = {(r["denial_code"], r["month"].isoformat()[:7]): (r["note_references"], round(r["weight"], 9), r["entries"])
           for r in patterns.knowledge_weight_by_month(Layer(spark, **frames)).collect()}
    assert got["CO-1", "2000-06"] == (1, 1.0, 1) and got["CO-1", "2000-12"] == (1, 1.0, 1) and got["CO-1", "2001-06"] == (0, 0.5, 1)
    assert got["CO-2", "2001-06"] == (0, 0.25, 0) and len(got) == 13 + 7


def test_bitmaps_over_several_buckets(spark):
    use = spark.range(90_000).select(F.lit(T0.date()).alias("period"), F.concat(F.lit("F"), (F.col("id") % 3).cast("string")).alias("facility_id"),
                                     F.concat(F.lit("N"), (F.col("id") % 70_000).cast("string")).alias("provider_npi"))
    tools = use.where("provider_npi like '%7'").union(spark.createDataFrame([(T0.date(), "F9", None)], use.schema))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in patterns.dex_distinct_providers(
        Layer(spark, clinician_ehr_usage=use, ai_tool_usage=tools)).collect()}
    assert got["all", None, None] == (70_000, 7000) and got["month", T0.date(), None] == (70_000, 7000)
    assert got["facility", None, "F0"][0] == use.where("facility_id = 'F0'").select("provider_npi").distinct().count()


def test_bucketed_joins_have_no_exchange_on_the_key(spark):
    import __spark_entry__ as entry
    from metric_helpers import SF_SMALL

    df = entry.queries()["quality_month_bucketed"](spark, SF_SMALL)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["quality_month_bucketed"](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin [encounter_id" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(encounter_id" in x]


def test_ordered_files_give_the_order(spark, tmp_path):
    import pyarrow.parquet as pq

    from strata.sources.sinks import ordered_files, write_ordered

    rows = spark.range(5000).select((F.col("id") * 37 % 211).cast("double").alias("v"), F.col("id").cast("string").alias("i"))
    path = str(tmp_path / "o")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(rows, path, ["v", "i"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = [t for f in ordered_files(spark, path) for t in zip(*(c.to_pylist() for c in pq.read_table(f.removeprefix("file:")).columns))]
    assert read == sorted((r["v"], r["i"]) for r in rows.collect()) and len(ordered_files(spark, path)) > 1


def test_stored_pairs_are_in_order(spark):
    import __spark_entry__ as entry
    import pyarrow.parquet as pq
    from metric_helpers import SF_SMALL

    from strata.sources.sinks import ordered_files

    layer = entry._layer(spark, SF_SMALL)
    layer.input("worklist_empi_duplicate_pairs")
    files = ordered_files(spark, layer.path("worklist_empi_duplicate_pairs"))
    read = [v for f in files for v in pq.read_table(f.removeprefix("file:"), columns=["min_confidence"]).column(0).to_pylist()]
    assert read == sorted(read, key=lambda v: (v is not None, v)) and len(read) == layer["worklist_empi_duplicate_pairs"].count()
    assert checkpoint_dir(spark)
