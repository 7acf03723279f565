import random

import duckdb

from strata.llm import quality_rules as qr


def same(spark, base):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{base}/documents.parquet/*.parquet')")
    want = sorted(map(str, con.execute(qr.ORACLE).fetchall()))
    got = sorted(str(tuple(r)) for r in qr.op6_quality_rules(spark, base).collect())
    assert got == want
    return got


def test_query_equals_sql(spark, write_table):
    rng = random.Random(1)
    words = ["a", "b", "the", "#", "c\td", "é", "\n", "x", "The"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, "a b c d e a b c d e"), (903, "w " * 2000), (None, "x\ny\nx\n")]
    same(spark, write_table(documents=spark.createDataFrame(rows, "doc_id long, text string")))


def test_edges(spark, write_table, edge_docs, no_docs):
    assert len(same(spark, write_table(documents=edge_docs))) == edge_docs.count()
    assert qr.op6_quality_rules(spark, write_table(documents=no_docs)).count() == 0
    out = qr.apply_rules(edge_docs)
    assert out.count() == edge_docs.count() and set(edge_docs.columns) <= set(out.columns)


def test_each_rule_decides(spark):
    good = "the cat and the dog sat in a garden of the old house\nand it is warm"
    texts = {"mean_word": "a b the c d e f g h i j k l", "symbol_ratio": good + " #### **** $$$$ |||| %%%% &&&& <<<< >>>>",
             "stop_ratio": "one two three four five six seven eight nine ten eleven", "none": good,
             "dup_line_ratio": "\n".join(["cat"] * 4 + ["the old dog sat in a big red house of stone"]),
             "base": " ".join(["the cat and the dog ran"] * 4)}
    df = qr.apply_rules(spark.createDataFrame(list(texts.items()), "name string, text string"))
    out = {r["name"]: r for r in df.collect()}
    assert out["none"]["kept"] and not any(out[n]["kept"] for n in texts if n != "none")
    assert out["base"]["base_failed"] and out["base"]["n_repeat_words"] == 24
    names = [name for name, *_ in qr.RULES]
    for name in ("mean_word", "symbol_ratio", "stop_ratio", "dup_line_ratio"):
        assert name in names and not out[name]["base_failed"]


def test_plan_is_one_projection_without_python(spark, edge_docs):
    plan = qr.apply_rules(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Generate"))
