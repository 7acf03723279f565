"""Quality rules: one threshold table compiled into one Spark projection.

``RULES`` names each ratio with its least and greatest value. ``measures``
builds the counts of a text from SQL functions only, ``verdict`` turns the
table into one boolean expression. Nothing is exploded or shuffled: repeated
five-word windows are found inside a row, on sorted arrays of hashes, and only
for texts that have any.

Words are runs of characters other than space and \\x09-\\x0D; lines are split
at \\n. Null texts have no words; like every text of under ten words they fail.
Rows are independent, so repeated rows and ties need no care. Columns that
clash with the results are replaced in ``apply_rules``; others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Characters that part words, symbols, stop words of the languages served.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = ("a", "and", "are", "as", "at", "be", "by", "das", "de", "del", "den", "der", "des", "die", "du", "el", "en",
              "est", "et", "for", "in", "is", "it", "la", "las", "le", "les", "los", "of", "on", "or", "que", "qui", "se",
              "su", "the", "to", "un", "und", "une", "was", "with", "y", "zu")
LEAST_WORDS, WINDOW, REPEATED_PERCENT = 10, 5, 20
#: (ratio, least, greatest); None: no such limit.
RULES = (
    ("mean_word", 2.0, 20.0),
    ("symbol_ratio", None, 0.3),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
    ("mean_line_words", 1.0, None),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice in the array."""
    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - window)
        return F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(window))))

    def covered(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(
                F.transform(s, lambda x, i: F.when((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]),
                                                   x["i"])), lambda i: i.isNotNull())
            return F.sort_array(twice)

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
        return _let(_let(pairs, places), total)

    def any_twice(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(_let(_let(hashes, windows), any_twice))


def measures(df: DataFrame) -> DataFrame:
    """``df`` (with text) and its counts and ratios."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " ", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    out = df.withColumns({"_words": words, "_lines": lines})
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_lines": F.size("_lines").cast("long"),
        "n_stop": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
    }).drop("_words", "_lines")
    return out.withColumns({
        "mean_word": F.try_divide("word_chars", "n_words"),
        "symbol_ratio": F.try_divide("n_symbols", "word_chars"),
        "stop_ratio": F.try_divide("n_stop", "n_words"),
        "dup_line_ratio": F.try_divide("n_dup_lines", "n_lines"),
        "mean_line_words": F.try_divide("n_words", "n_lines"),
    })


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def verdict(rules=RULES) -> Column:
    """Whether every ratio lies within its limits (a ratio of nothing does not)."""
    out = F.lit(True)
    for name, least, greatest in rules:
        if least is not None:
            out = out & (F.col(name) >= least)
        if greatest is not None:
            out = out & (F.col(name) <= greatest)
    return F.coalesce(out, F.lit(False))


def apply_rules(df: DataFrame, rules=RULES) -> DataFrame:
    return measures(df).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*COLUMNS)


def _oracle(rules=RULES) -> str:
    limits = " AND ".join(f"{name} {op} {value}" for name, least, greatest in rules
                          for op, value in ((">=", least), ("<=", greatest)) if value is not None)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT row, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2, lead(word, 3) OVER o AS w3,
             lead(word, 4) OVER o AS w4 FROM p WINDOW o AS (PARTITION BY row ORDER BY i)),
c AS (SELECT row, i, count(*) OVER (PARTITION BY row, word, w1, w2, w3, w4) AS n FROM g WHERE w4 IS NOT NULL),
r AS (SELECT row, count(DISTINCT i + k) AS n FROM c, range({WINDOW}) t(k) WHERE n > 1 GROUP BY row),
m AS (SELECT w.row, doc_id, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(lines) AS n_lines, len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS n_stop
      FROM w LEFT JOIN r ON r.row = w.row),
q AS (SELECT *, word_chars / nullif(n_words, 0) AS mean_word, n_symbols / nullif(word_chars, 0) AS symbol_ratio,
             n_stop / nullif(n_words, 0) AS stop_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
             n_words / nullif(n_lines, 0) AS mean_line_words,
             n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {limits}, false) AS kept FROM q"""


ORACLE = _oracle()
