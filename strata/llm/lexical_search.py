"""Ranked lexical search: an automaton of the queries' terms scans the documents.

There is no index. All terms of a block of items form one Aho-Corasick
automaton, each term guarded by a separator on both sides, and the documents
are read twice:

1. the first scan counts, map-side, the documents that hold each term (df), the
   documents with terms (N) and their terms (L);
2. the second scan counts the terms of a document again, weighs them, and adds
   each weight to the items the automaton's output maps to. A task keeps the best
   ``top`` documents of each item; these few rows are ranked in two steps, so no
   task sees the lists of all others.

Documents are never shuffled and only counts of the items' own terms (a block
has ``QUERY_BYTES`` of item text) reach the driver and the broadcasts. A larger
set of items is more blocks, each with its two scans.

Terms are runs of ASCII letters and digits and of non-ASCII characters; only
A-Z are lower-cased. Scores are 64-bit integers (weights: floor of a double).
Null, empty and wordless texts are no documents; items without terms give no
rows. Rows of one item_id are one item with all their terms, a null item_id is
an item too. Each row of the documents is a document; equal scores go by
ascending doc_id, null last; repeated rows keep their places. Texts are counted
whole, of any length. Extra columns are not read.
"""

from __future__ import annotations

import math
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import released, ship, table, text_slices
from .textcore import ALNUM, LOWER

TOP = 10
#: Bytes of item text that one automaton holds.
QUERY_BYTES = 1 << 20
#: Groups of tasks whose best documents are ranked first.
GROUPS = 256
#: Candidates of a task before it drops all but the best, and sums held at once.
HELD, SUMS = 1 << 18, 1 << 21
#: Lower-cased term bytes, a space for any other byte.
_TERMS = np.where(ALNUM[LOWER], LOWER, 32).astype(np.uint8).tobytes()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERMS).split()


class Queries:
    """The distinct terms of some items, their automaton, and the items of each term."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.ids = [i for i, _ in items]
        self.terms = sorted({t for _, own in items for t in own})
        number = {t: n for n, t in enumerate(self.terms)}
        pairs = sorted((number[t], i) for i, (_, own) in enumerate(items) for t in set(own))
        self.items = np.array([i for _, i in pairs], dtype=np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs]), np.arange(len(self.terms) + 1))
        self.automaton = ahocorasick.Automaton()
        for n, t in enumerate(self.terms):
            self.automaton.add_word(f" {t.decode('latin-1')} ", n)
        self.automaton.make_automaton()

    def counts(self, texts: list[bytes]):
        """Terms of each text, and (text, term, times) of the items' terms in them."""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        joined = b" " + b" ".join(texts).translate(_TERMS) + b" "
        bounds = np.concatenate(([0], np.cumsum(sizes + 1)))  # text i lies after bounds[i]
        inside = np.frombuffer(joined, dtype=np.uint8) != 32
        begun = np.concatenate(([0], np.cumsum(inside[1:] & ~inside[:-1])))
        n = np.diff(begun[np.minimum(bounds, len(begun) - 1)])
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(joined.decode("latin-1"))), dtype=np.int64)
        end, term = hits[0::2], hits[1::2]
        text = np.searchsorted(bounds, end - 1, "right") - 1
        key, times = np.unique(text * max(len(self.terms), 1) + term, return_counts=True)
        return n, key // max(len(self.terms), 1), key % max(len(self.terms), 1), times

    def scores(self, rows: int, row: np.ndarray, term: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Sum of the parts of each (row, item), by the items of each term."""
        size = np.diff(self.first)[term]
        item = self.items[np.repeat(self.first[term] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        out = np.zeros(rows * len(self.ids), dtype=np.int64)
        np.add.at(out, np.repeat(row * len(self.ids), size) + item, np.repeat(part, size))
        return out.reshape(rows, len(self.ids))


COUNTS = "term int, n long, terms long"


def _document_counts(shared):
    """(term, documents that hold it); term -1 is (documents with terms, their terms)."""
    @released
    def run(batches):
        queries = Queries(shared.value)
        df = np.zeros(len(queries.terms), dtype=np.int64)
        documents = total = 0
        for batch in batches:
            for _, _, texts in text_slices(batch, 0):
                n, _, term, _ = queries.counts(texts)
                df += np.bincount(term, minlength=len(df))
                documents += int((n > 0).sum())
                total += int(n.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(df[seen], documents)),
             pa.array(np.append(np.zeros(len(seen), dtype=np.int64), total))], names=["term", "n", "terms"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The best ``top`` documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, dtype=np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        self.held.append((item, scores[row, item], doc[row], null[row]))
        self.size += len(row)
        if self.size > HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        last = place == self.top - 1
        self.least[item[last]] = score[last]
        keep = place < self.top
        self.held, self.size = [(item[keep], score[keep], doc[keep], null[keep])], int(keep.sum())
        return self.held[0]


FOUND = "item int, doc_id long, score long"


def _best_documents(shared, weights, top: int):
    @released
    def run(batches):
        queries = Queries(shared.value)
        documents, total, w = weights.value
        best = Best(len(queries.ids), top)
        step = max(1, SUMS // max(len(queries.ids), 1))
        for batch in batches:
            for lo, hi, texts in text_slices(batch, 1):
                ids = batch.column(0).slice(lo, hi - lo).cast(pa.int64())
                null = np.array(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.int64)
                doc = ids.fill_null(0).to_numpy()
                for a in range(0, hi - lo, step):
                    b = min(a + step, hi - lo)
                    n, row, term, times = queries.counts(texts[a:b])
                    # Python integers: 90 n N may need more than 64 bits before the division
                    m = np.array([10 + 90 * x * documents // total for x in n.tolist()], dtype=np.int64)
                    part = w[term] * (1_000_000_000 * times // (1000 * times + 8 * m[row]))
                    best.add(queries.scores(b - a, row, term, part), doc[a:b], null[a:b])
        item, score, doc, null = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, mask=null > 0), pa.array(score)],
                                         names=["item", "doc_id", "score"])
    return run


def item_blocks(benchmark: DataFrame):
    """(item_id, terms) lists of about QUERY_BYTES of text, one block at a time."""
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // QUERY_BYTES)
    for block in range(blocks):
        terms: dict[object, set[bytes]] = {}
        for row in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            terms.setdefault(row["item_id"], set()).update(terms_of(row["text"]))
        found = sorted(((i, sorted(t)) for i, t in terms.items() if t), key=lambda x: (x[0] is None, x[0] or 0))
        if found:
            yield found


def search(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score."""
    ship(spark)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    docs = docs.select("doc_id", "text")
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)
        counted = docs.select("text").mapInArrow(_document_counts(shared), COUNTS).groupBy("term").agg(
            F.sum("n").alias("n"), F.sum("terms").alias("terms")).collect()
        found = {r["term"]: r["n"] for r in counted}
        documents = found.pop(-1, 0)
        total = next((r["terms"] for r in counted if r["term"] == -1), 0)
        if not total:
            break
        terms = len({t for _, own in items for t in own})
        w = np.array([weight(documents, found.get(t, 0)) for t in range(terms)], dtype=np.int64)
        weights = spark.sparkContext.broadcast((documents, total, w))
        best = docs.mapInArrow(_best_documents(shared, weights, top), FOUND)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        first = Window.partitionBy("item", "group").orderBy(*order)
        best = best.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS))).withColumn(
            "rank", F.row_number().over(first)).where(F.col("rank") <= top)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(
            F.col("rank") <= top)
        ids = F.array(*[F.lit(i).cast("long") for i, _ in items])
        out = out.unionByName(best.select(F.element_at(ids, F.col("item") + 1).alias("item_id"), "rank", "doc_id", "score"))
    return out


def op11_automaton_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE = f"""
WITH words AS (SELECT r, doc_id, unnest(w) AS term FROM (
    SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents WHERE text IS NOT NULL)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
query AS (SELECT DISTINCT item_id, unnest({_SPLIT}) AS term FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM query) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, corpus GROUP BY term),
parts AS (SELECT tf.r, s.doc_id, tf.term,
    w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * s.n * c.docs) // c.terms))) AS part
  FROM tf JOIN w USING (term) JOIN sizes s ON s.r = tf.r CROSS JOIN corpus c),
scores AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM parts JOIN query USING (term) GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS place
  FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {TOP}"""
