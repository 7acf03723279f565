"""Language identification with hyperdimensional n-gram profiles.

Every letter (and the blank, which stands for any run of other characters) has
a fixed random vector of +1 and -1, drawn from its code point. A trigram is
bound from its letters: the first vector rotated twice, the second rotated
once, the third, multiplied. A text is the sum of its trigrams, a language the
sum of its training texts, and a text gets the language with the greatest
cosine. Equal cosines go to the language first in the alphabet.

Training sums are whole numbers, so they do not depend on the order of tasks;
a task returns one vector for each language. Null texts and texts without a
letter are ``und`` with score 0, as are all texts if nothing was learned.
Rows with a null language or text teach nothing. Repeated rows count each
time. Extra columns are kept by ``identify`` unless their names clash with its
results; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, ship, table, text_slices
from .textcore import U, mix

DIMENSIONS = 1024
UNKNOWN = "und"
#: Trigram vectors a worker keeps.
KEPT_TRIGRAMS = 20_000
#: Trigrams multiplied at once.
BLOCK = 4096
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def letter_vectors(code: np.ndarray) -> np.ndarray:
    """One random vector of +1 and -1 for each code point."""
    words = np.arange(DIMENSIONS // 64, dtype=U)[None, :] * U(0x9E3779B97F4A7C15)
    bits = mix(mix(code.astype(U) + U(0x2545F4914F6CDD1D))[:, None] + words)
    ones = np.unpackbits(bits.view(np.uint8), axis=1)
    return (ones.astype(np.int8) * 2 - 1)[:, :DIMENSIONS]


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, trigram) of all trigrams; a trigram is three 21-bit code points."""
    # a zero before each text, a blank around it; zeros of the text itself become blanks
    joined = "".join("\0 " + t.decode("utf-8", "replace").lower().replace("\0", " ") + " " for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    mark = code == 0
    letter = letters()[code]
    keep = letter | mark
    keep[1:] |= letter[:-1]  # the first of other characters in a row
    keep[np.flatnonzero(mark) + 1] = True
    code = np.where(letter | mark, code, 32)[keep]
    text = np.cumsum(code == 0) - 1
    if len(code) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    key = (code[:-2] << 42) | (code[1:-1] << 21) | code[2:]
    fit = (code[:-2] != 0) & (code[1:-1] != 0) & (code[2:] != 0) & (key != _BLANKS)
    return text[:-2][fit], key[fit]


_BLANKS = (32 << 42) | (32 << 21) | 32


def counts(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct trigrams, then for each (group, trigram): group, its place, count)."""
    # number the characters of the batch densely, so that plain sorting does
    parts = np.stack((key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF))
    used = np.zeros(0x110000, dtype=bool)
    used[parts.ravel()] = True
    alphabet = np.flatnonzero(used)
    number = np.zeros(0x110000, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    n = max(1, len(alphabet))
    a, b, c = number[parts[0]], number[parts[1]], number[parts[2]]
    pair = np.sort(group * n ** 3 + (a * n + b) * n + c)
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(pair)))
    pair = pair[first]
    dense = pair % n ** 3
    distinct, place = np.unique(dense, return_inverse=True)
    full = (alphabet[distinct // n ** 2] << 42) | (alphabet[distinct // n % n] << 21) | alphabet[distinct % n] \
        if len(distinct) else distinct
    return full, pair // n ** 3, place, count


class TrigramVectors:
    """Vectors of trigrams, kept for as many as KEPT_TRIGRAMS."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.table = np.zeros((KEPT_TRIGRAMS, DIMENSIONS), dtype=np.int8)

    @staticmethod
    def bind(key: np.ndarray) -> np.ndarray:
        code, at = np.unique(np.concatenate((key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF)), return_inverse=True)
        v = letter_vectors(code)
        a, b, c = at.reshape(3, -1)
        return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]

    def get(self, key: np.ndarray) -> np.ndarray:
        """The vectors of distinct trigrams, one row each."""
        keys = key.tolist()
        rows = [self.row.get(k, -1) for k in keys]
        new = [i for i, r in enumerate(rows) if r < 0]
        if new:
            if len(self.row) + len(new) > KEPT_TRIGRAMS:
                if len(keys) > KEPT_TRIGRAMS:
                    return self.bind(key)
                self.row, rows, new = {}, [-1] * len(keys), list(range(len(keys)))
            base = len(self.row)
            self.table[base:base + len(new)] = self.bind(key[new])
            for j, i in enumerate(new):
                self.row[keys[i]] = rows[i] = base + j
        return self.table[rows]


@released
def _sums(batches):
    vectors, total = TrigramVectors(), {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, hi, texts in text_slices(batch, 1):
            names = sorted(set(langs[lo:hi]))
            which = np.array([names.index(x) for x in langs[lo:hi]])
            text, key = trigrams(texts)
            full, lang, place, n = counts(which[text], key)
            if not len(full):
                continue
            v = vectors.get(full)
            for i in np.unique(lang):
                own = lang == i
                add = np.zeros(DIMENSIONS, dtype=np.int64)
                at, c = place[own], n[own]
                for j in range(0, len(at), 4096):
                    # exact: counts in a batch stay far below 2**53
                    add += (c[j:j + 4096].astype(np.float64) @ v[at[j:j + 4096]].astype(np.float64)).astype(np.int64)
                total[names[i]] = total.get(names[i], 0) + add
    for name, v in sorted(total.items()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(v)],
            names=["lang", "d", "v"])


def train(spark: SparkSession, labelled: DataFrame) -> dict[str, list[int]]:
    """Language prototypes from (lang, text); one vector for each language."""
    ship(spark)
    known = labelled.select("lang", "text").where("lang is not null and text is not null")
    rows = known.mapInArrow(_sums, "lang string, d int, v long").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    out: dict[str, list[int]] = {}
    for r in rows.collect():
        out.setdefault(r["lang"], [0] * DIMENSIONS)[r["d"]] = r["v"]
    return dict(sorted(out.items()))


def predict(texts: list[bytes], names: list[str], profile: np.ndarray,
            vectors: TrigramVectors) -> tuple[list[str], np.ndarray]:
    """Language and cosine of each text; ``profile`` has unit rows."""
    best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    text, key = trigrams(texts)
    full, text, place, n = counts(text, key)
    if not len(full) or not names:
        return best, score
    bundle = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    cut = np.searchsorted(place[order], np.arange(0, len(full) + BLOCK, BLOCK))
    v = vectors.get(full)
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        own = order[a:b]
        part = np.zeros((len(texts), BLOCK), dtype=np.float32)
        part[text[own], place[own] - i * BLOCK] = n[own]
        piece = v[i * BLOCK:(i + 1) * BLOCK].astype(np.float32)
        bundle += part[:, :len(piece)] @ piece
    bundle = bundle.astype(np.float64)
    some = np.bincount(text, minlength=len(texts)) > 0
    size = np.linalg.norm(bundle, axis=1)
    cosine = bundle @ profile.T / np.where(size > 0, size, 1)[:, None]
    top = cosine.argmax(axis=1)
    for i in np.flatnonzero(some):
        best[i], score[i] = names[top[i]], min(1.0, max(0.0, cosine[i, top[i]]))
    return best, score


def _predictions(names: list[str], vectors: list[list[int]], column: str):
    @released
    def run(batches):
        profile = np.array(vectors, dtype=np.float64).reshape(len(names), DIMENSIONS)
        profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-300)
        kept = TrigramVectors()
        for batch in batches:
            for lo, hi, texts in text_slices(batch, batch.schema.get_field_index(column)):
                best, score = predict(texts, names, profile, kept)
                yield pa.RecordBatch.from_arrays(
                    [*(x.slice(lo, hi - lo) for x in batch.columns), pa.array(best), pa.array(score)],
                    names=[*batch.schema.names, "lang_pred", "score"])
    return run


def identify(spark: SparkSession, df: DataFrame, prototypes: dict[str, list[int]]) -> DataFrame:
    """``df`` (with text) and lang_pred, score."""
    ship(spark)
    df = df.drop("lang_pred", "score")
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return df.mapInArrow(_predictions(list(prototypes), list(prototypes.values()), "text"), schema)


def held_out(docs: DataFrame):
    """Every fifth document by the checksum of its id (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op9_hyperdimensional_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = train(spark, docs.where(~held_out(docs)))
    rows = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return identify(spark, rows, prototypes).select("doc_id", "held_out", "lang_pred", "score")
