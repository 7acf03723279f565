"""Corpus pipeline: language ID, near-dedup, suffix-array dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all
but the last return the columns of ``documents``. The decisions:

* ``language_id`` learns from the labelled rows and drops documents without a
  language (``und``: null texts and texts without a letter);
* ``near_dedup`` keeps one document of each group of near copies;
* ``suffix_dedup`` cuts passages that occur elsewhere too out of the texts, if they
  have over fifty words or 400 bytes (what is left of a character that was cut in
  two goes too), and counts n_chars anew;
* ``decontaminate`` drops documents that contain a benchmark item;
* ``tokens`` encodes and decodes the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bag_minhash, byte_bpe, decontaminate, language_id, suffix_dedup
from strata.llm.common import stored, table


# A passage has over so many words; it is found by strings of so many bytes that recur. In the given
# documents 98 of 100 passages of over fifty words have more than that.
PASSAGE_WORDS, PASSAGE_BYTES = 50, 240


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = language_id.train(spark, docs.where(~language_id.held_out(docs)))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "text")
    named = language_id.identify(spark, rows, prototypes)
    return named.where(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.near_dedup(spark, docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "doc_id", "text")
    out = suffix_dedup.suffix_dedup(spark, rows, PASSAGE_BYTES, PASSAGE_WORDS)
    cut = F.col("n_removed") > 0
    rest = suffix_dedup.whole_characters(F.when(cut, F.col("kept")), F.when(cut, F.col("spans")))
    new = {"text": F.when(cut, rest).otherwise(F.col("text")),
           "n_chars": F.when(cut, F.length(rest).cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.tokens_and_text(spark, docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_stage),
    ("suffix_dedup", suffix_stage),
    ("decontaminate", benchmark_stage),
    ("tokens", token_stage),
]

#: Hyperdimensional vectors, suffix arrays and BPE cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(spark, docs, f"pipeline-{name}")
    return docs
