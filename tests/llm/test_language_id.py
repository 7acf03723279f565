import numpy as np
from pyspark.sql import functions as F

from strata.llm import language_id as li

SF = "/root/testdata/sf0.01"


def plain_bundle(text):
    """Sum of bound trigrams of one text, letter by letter."""
    s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in s:
        s = s.replace("  ", " ")
    v = {c: li.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in set(s)}
    total = np.zeros(li.DIMENSIONS, dtype=int)
    for a, b, c in zip(s, s[1:], s[2:]):
        total += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return total


def test_bundles_equal_the_plain_sum():
    for text in ("Abc, abc! déjà vu", "a", "x" * 300 + " 12 y", "日本語 の 文"):
        t, key = li.trigrams([text.encode()])
        full, _, place, n = li.counts(t, key)
        v = li.TrigramVectors().get(full)
        assert (n @ v[place].astype(int) == plain_bundle(text)).all()


def test_letter_vectors_are_nearly_orthogonal():
    v = li.letter_vectors(np.arange(97, 123)).astype(int)
    assert set(np.unique(v)) == {-1, 1}
    dots = v @ v.T - np.eye(26, dtype=int) * li.DIMENSIONS
    assert abs(dots).max() < 6 * li.DIMENSIONS ** 0.5


def test_held_out_accuracy(spark):
    out = li.op9_hyperdimensional_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = out.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_edges(spark, write_table, edge_docs, no_docs):
    out = li.op9_hyperdimensional_language_id(spark, write_table(documents=edge_docs)).collect()
    assert len(out) == edge_docs.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], r)
    for doc in (3, 4, 5):
        assert (by[doc]["lang_pred"], by[doc]["score"]) == ("und", 0.0)
    assert by[6]["lang_pred"] == "en"
    kept = li.identify(spark, edge_docs, {})
    assert {r["lang_pred"] for r in kept.collect()} == {"und"} and set(edge_docs.columns) <= set(kept.columns)
    assert li.op9_hyperdimensional_language_id(spark, write_table(documents=no_docs)).count() == 0
