"""Interpolated modified Kneser-Ney language model and text scores.

An n-gram model over whole words (one end token a text, start symbols before
it); ``order`` is n, two or more. Counting runs in Spark tasks on 64-bit word
hashes (equal hashes count as equal words):

1. Tasks aggregate the n-grams of a few million tokens at a time and send them
   by shard. An n-gram's shard follows from its context, the words before its
   last one; n-grams of a very frequent context (at least 1/4000 of all tokens,
   so 4000 of each length at most) are spread over all shards by their own hash.
2. A shard, one task each, adds up its n-grams, writes them as a sorted hash
   array with counts into the shared folder, and so the sums of its contexts:
   total, followers seen once, twice, and more often (of a frequent context the
   parts are added up one step later). For the next shorter n-grams it sends how
   many n-grams it has that end in them; these are their counts, and the step is
   repeated down to single words. Counts of words go along.
3. The last step writes sorted arrays of the words.

Scoring tasks memory-map the arrays and look up sorted batches of hashes, so
each array is read from front to back. Nothing but totals reaches the driver,
and memory holds one batch or one shard. A batch of ``SCORED`` tokens opens each
shard's files once, so tokens / SCORED x shards file searches are made: raise
both ``SHARD_BYTES`` and ``SCORED`` with the corpus and the executors' memory.
Files are written under another name and renamed, with the same content whenever
a task is repeated.

Null and empty texts are one end token. A null doc_id has the checksum of the
empty text (held out). Every row is scored and counted for itself, repeated
rows too. Without training text the model is uniform. Extra columns are not
read.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, shared_folder, ship, table, text_slices
from .textcore import U, VISIBLE, Words, mix

ORDER = 2
START, END = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
#: Tokens aggregated, and tokens scored, at once.
CHUNK, SCORED = 2_500_000, 1_000_000
#: Bytes of training text for each shard of the model.
SHARD_BYTES = 32 << 20
FREQUENT = 2000
_C = U(0x9E3779B97F4A7C15)


def tokens(batches, column: int, chunk: int):
    """(batch, first row, end row, token hashes, row of each token) of runs of texts of about ``chunk`` tokens."""
    for batch in batches:
        got: list[tuple[np.ndarray, np.ndarray]] = []
        first = count = 0
        for lo, hi, texts in text_slices(batch, column, 2 << 20):
            w = Words(texts, True, VISIBLE)
            n = w.n + 1
            text = np.repeat(np.arange(lo, hi), n)
            h = np.empty(int(n.sum()), dtype=U)
            last = np.cumsum(n) - 1
            word = np.ones(len(h), dtype=bool)
            word[last] = False
            h[word] = w.hash
            h[last] = END
            got.append((h, text))
            count += len(h)
            if count >= chunk:
                yield batch, first, hi, np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
                got, first, count = [], hi, 0
        if got:
            yield batch, first, batch.num_rows, np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])


def chunks(batches):
    """(token hashes, text of each token) of about CHUNK tokens, over several batches."""
    got: list[tuple[np.ndarray, np.ndarray]] = []
    count = texts = 0
    for _, _, _, h, text in tokens(batches, 0, CHUNK):
        got.append((h, text + texts))
        texts += int(text.max(initial=0)) + 1
        count += len(h)
        if count >= CHUNK:
            yield tuple(np.concatenate(x) for x in zip(*got))
            got, count = [], 0
    if got:
        yield tuple(np.concatenate(x) for x in zip(*got))


def contexts(h: np.ndarray, text: np.ndarray, words: int) -> list[np.ndarray]:
    """Hashes of the contexts of 0 to ``words`` words before each token; start symbols before a text."""
    out = [np.zeros(len(h), dtype=U)]
    for k in range(1, words + 1):
        before = np.full(len(h), START, dtype=U)
        inside = np.flatnonzero(text[k:] == text[:-k]) if len(h) > k else np.zeros(0, dtype=np.int64)
        before[inside + k] = h[inside]
        out.append(mix(out[-1] * _C + before))
    return out


def gram(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _C + word)


def sharded_by(context: np.ndarray, key: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """What decides an n-gram's shard: its context, or itself if that is frequent."""
    return np.where(np.isin(context, frequent), key, context)


def shard_of(by: np.ndarray, shards: int) -> np.ndarray:
    return ((by >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def small(values: np.ndarray) -> np.ndarray:
    """The same numbers with as few bytes as the largest needs."""
    top = int(values.max(initial=0))
    return values.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max))


def packed(values: np.ndarray) -> bytes:
    values = small(values)
    return bytes([values.dtype.itemsize]) + np.ascontiguousarray(values).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"u{data[0]}"), offset=1).astype(np.int64)


def _merged(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the place of the first row of each, and the sums of each value."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    if not len(keys):
        return keys, order, *values
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], order[first], *(np.add.reduceat(v[order], first) for v in values)


def _often(lists: dict[int, list[int]], words: int) -> np.ndarray:
    """The frequent contexts of so many words."""
    return np.array(lists.get(words, []), dtype=np.int64).view(U)


def _frequent_contexts(order: int):
    @released
    def run(batches):
        for h, text in chunks(batches):
            rows = [(0, 0, 0, len(h))]
            for words, c in enumerate(contexts(h, text, order - 1)):
                if words:
                    own, n = np.unique(c, return_counts=True)
                    big = n * FREQUENT >= len(c)
                    rows += [(words, w, k, 0) for w, k in zip(own[big].view(np.int64).tolist(), n[big].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)],
                                             names=["words", "context", "n", "tokens"])
    return run


#: What is sent to a shard. ``length`` of n-grams: their contexts, followers of each, the shorter
#: contexts of each, words and counts. COUNTED: words and their counts. SUMS: contexts of ``length``
#: words and their four sums. TALLY: counts of counts of a step.
SENT = "shard int, kind int, length int, context binary, followers binary, lower binary, word binary, n binary"
_SENT = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("length", pa.int32()),
                   *((x, pa.binary()) for x in ("context", "followers", "lower", "word", "n"))])
GRAMS, COUNTED, SUMS, TALLY = range(4)


def _sent_grams(length: int, shards: int, often: np.ndarray, context: np.ndarray, lower: np.ndarray, word: np.ndarray,
                n: np.ndarray) -> list[tuple]:
    """Rows of distinct n-grams, one a shard. ``lower`` has a column for each shorter context."""
    shard = shard_of(sharded_by(context, gram(context, word), often), shards)
    order = np.lexsort((context, shard))
    shard, context, lower, word, n = shard[order], context[order], lower[order], word[order], n[order]
    at = np.searchsorted(shard, np.arange(shards + 1))
    rows = []
    for i in np.flatnonzero(at[1:] > at[:-1]):
        a, b = at[i], at[i + 1]
        own = context[a:b]
        head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        rows.append((int(i), GRAMS, length, own[head].tobytes(), packed(np.diff(np.append(head, b - a))),
                     lower[a:b][head].tobytes(), word[a:b].tobytes(), packed(n[a:b])))
    return rows


def _sent_words(shards: int, word: np.ndarray, n: np.ndarray) -> list[tuple]:
    order = np.argsort(word)
    word, n = word[order], n[order]
    at = np.searchsorted(shard_of(word, shards), np.arange(shards + 1))
    return [(int(i), COUNTED, 1, None, None, None, word[at[i]:at[i + 1]].tobytes(), packed(n[at[i]:at[i + 1]]))
            for i in np.flatnonzero(at[1:] > at[:-1])]


def _first_grams(order: int, shards: int, often: dict[int, list[int]]):
    @released
    def run(batches):
        for h, text in chunks(batches):
            c = contexts(h, text, order - 1)
            _, first, n = _merged(gram(c[-1], h), np.ones(len(h), dtype=np.int64))
            lower = np.stack([x[first] for x in c[order - 2:0:-1]], axis=1) if order > 2 else np.zeros((len(first), 0), dtype=U)
            rows = _sent_grams(order, shards, _often(often, order - 1), c[-1][first], lower, h[first], n)
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _SENT, strict=True)], schema=_SENT)


def _write(folder: str, name: str, values: np.ndarray) -> None:
    at = os.path.join(folder, name + ".npy")
    new = f"{at}.{uuid.uuid4().hex}"
    with open(new, "wb") as f:
        np.save(f, np.ascontiguousarray(values))
    os.replace(new, at)


def _map(folder: str, name: str) -> np.ndarray | None:
    at = os.path.join(folder, name + ".npy")
    return np.load(at, mmap_mode="r") if os.path.exists(at) else None


def _counts_of_counts(n: np.ndarray) -> np.ndarray:
    """Types with one, two, three, four, and more; types; their sum."""
    return np.concatenate((np.bincount(np.minimum(n, 5), minlength=6)[1:6], [int((n > 0).sum()), int(n.sum())]))


class _Step:
    """What a shard does with what it was sent: the n-grams of one length, or single words at last."""

    def __init__(self, folder: str, length: int, order: int, shards: int, often: dict[int, list[int]]):
        self.folder, self.length, self.order, self.shards, self.often = folder, length, order, shards, often

    def frequent_sums(self, group: pa.Table, shard: int) -> None:
        """Add up the parts of the frequent contexts of the step before."""
        parts = [(np.frombuffer(c, U), np.frombuffer(n, np.int64).reshape(4, -1)) for k, c, n in
                 zip(*(group.column(x).to_pylist() for x in ("kind", "context", "n"))) if k == SUMS]
        if parts:
            own, _, *sums = _merged(np.concatenate([c for c, _ in parts]), *np.concatenate([n for _, n in parts], axis=1))
            _write_sums(self.folder, f"often-{self.length + 1}-{shard}", own, sums)

    def grams(self, group: pa.Table, shard: int) -> list[tuple]:
        width = max(self.length - 2, 0)
        ctx, lower, word, n = [], [], [], []
        for kind, c, f, low, w, k in zip(*(group.column(x).to_pylist() for x in
                                           ("kind", "context", "followers", "lower", "word", "n")), strict=True):
            if kind == GRAMS:
                times = unpacked(f)
                ctx.append(np.repeat(np.frombuffer(c, U), times))
                lower.append(np.repeat(np.frombuffer(low, U).reshape(len(times), width), times, axis=0))
                word.append(np.frombuffer(w, U))
                n.append(unpacked(k))
        if not ctx:
            return []
        ctx, lower, word, n = (np.concatenate(x) for x in (ctx, lower, word, n))
        key, first, n = _merged(gram(ctx, word), n)
        ctx, lower, word = ctx[first], lower[first], word[first]
        name = f"{self.length}-{shard}"
        _write(self.folder, f"gram-{name}", key)
        _write(self.folder, f"count-{name}", np.minimum(n, 255).astype(np.uint8))
        big = n >= 255
        _write(self.folder, f"big-{name}", key[big])
        _write(self.folder, f"bigcount-{name}", n[big])
        rows = [(shard, TALLY, self.length, None, None, None, None, _counts_of_counts(n).tobytes())]
        own, _, *sums = _merged(ctx, n, *((x).astype(np.int64) for x in (n == 1, n == 2, n > 2)))
        part = np.isin(own, _often(self.often, self.length - 1))
        _write_sums(self.folder, f"context-{name}", own[~part], [x[~part] for x in sums])
        if part.any():
            to = shard_of(own[part], self.shards)
            for i in np.unique(to):
                rows.append((int(i), SUMS, self.length - 1, own[part][to == i].tobytes(), None, None, None,
                             np.stack([x[part][to == i] for x in sums]).astype(np.int64).tobytes()))
        # n-grams that end in each shorter one
        if self.length > 2:
            short, at, types = _merged(gram(lower[:, 0], word), np.ones(len(word), dtype=np.int64))
            rows += _sent_grams(self.length - 1, self.shards, _often(self.often, self.length - 2), lower[at, 0], lower[at, 1:],
                                word[at], types)
        else:
            own, _, types = _merged(word, np.ones(len(word), dtype=np.int64))
            at = np.searchsorted(shard_of(own, self.shards), np.arange(self.shards + 1))
            rows += [(int(i), GRAMS, 1, None, None, None, own[at[i]:at[i + 1]].tobytes(), packed(types[at[i]:at[i + 1]]))
                     for i in np.flatnonzero(at[1:] > at[:-1])]
        if self.length == self.order:
            own, _, times = _merged(word, n)
            rows += _sent_words(self.shards, own, times)
        return rows

    def __call__(self, group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        self.frequent_sums(group, shard)
        rows = self.grams(group, shard)
        kinds = group.column("kind").to_pylist()
        onward = [tuple(group.column(x)[i].as_py() for x in _SENT.names) for i, k in enumerate(kinds) if k in (COUNTED, TALLY)]
        return pa.Table.from_batches([_batch(rows + onward)] if rows or onward else [], schema=_SENT)


def _write_sums(folder: str, name: str, context: np.ndarray, sums: list[np.ndarray]) -> None:
    order = np.argsort(context)
    _write(folder, name, context[order])
    for part, values in zip(("total", "one", "two", "more"), sums, strict=True):
        _write(folder, f"{name}-{part}", small(values[order]))


TALLIES = "length int, n1 long, n2 long, n3 long, n4 long, more long, types long, total long"


class _Words(_Step):
    """The last step: the words of a shard, and all tallies."""

    def __call__(self, group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        self.frequent_sums(group, shard)
        words, count, before, tallies = [], [], [], []
        for kind, length, w, n in zip(*(group.column(x).to_pylist() for x in ("kind", "length", "word", "n")), strict=True):
            if kind == TALLY:
                tallies.append((length, *np.frombuffer(n, np.int64).tolist()))
            elif kind in (GRAMS, COUNTED):
                words.append(np.frombuffer(w, U))
                times = unpacked(n)
                count.append(times if kind == COUNTED else np.zeros(len(times), dtype=np.int64))
                before.append(times if kind == GRAMS else np.zeros(len(times), dtype=np.int64))
        if words:
            word, _, count, before = _merged(np.concatenate(words), np.concatenate(count), np.concatenate(before))
            _write(self.folder, f"word-{shard}", word)
            _write(self.folder, f"times-{shard}", small(count))
            _write(self.folder, f"before-{shard}", small(before))
            tallies.append((1, *_counts_of_counts(before).tolist()))
            tallies.append((0, 0, 0, 0, 0, 0, int((count > 0).sum()), int(count.sum())))
        columns = list(zip(*tallies)) or [()] * 8
        names = [x.split()[0] for x in TALLIES.split(", ")]
        return pa.table([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.int64()) for x in columns[1:])], names=names)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts; one half of the count where a count of counts is missing."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.01), i + 0.99) for i, x in enumerate(d))


def less(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts."""
    return np.maximum(n - np.array([0.0, *d])[np.minimum(n, 3)], 0)


@dataclass
class Model:
    folder: str
    order: int
    shards: int
    often: dict[int, list[int]]
    total: int
    types: int
    #: number of different pairs, discounts of each length, and what they take from single words
    pairs: int
    taken: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    rest: float = 0.0

    def lookup(self, shard: np.ndarray, key: np.ndarray, name: str):
        """For each shard with keys: its number, their places in its sorted array, and the rows found there."""
        order = np.argsort(key)
        order = order[np.argsort(shard[order].astype(np.uint16 if self.shards < 65536 else np.int64), kind="stable")]
        at = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(at[1:] > at[:-1]):
            own = order[at[s]:at[s + 1]]
            have = _map(self.folder, f"{name}-{s}")
            if have is None or not len(have):
                continue
            place = np.searchsorted(have, key[own])
            place[place == len(have)] = 0
            found = have[place] == key[own]
            yield s, place[found], own[found]

    def values(self, name: str, s: int, part: str, place: np.ndarray) -> np.ndarray:
        return _map(self.folder, f"{name}-{s}{part}")[place].astype(np.int64)

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, different words before) of each word."""
        count, before = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=np.int64)
        for s, place, rows in self.lookup(shard_of(h, self.shards), h, "word"):
            count[rows], before[rows] = self.values("times", s, "", place), self.values("before", s, "", place)
        return count, before

    def sums(self, length: int, context: np.ndarray) -> np.ndarray:
        """Total, followers once, twice, more of each context of n-grams of a length."""
        out = np.zeros((len(context), 4), dtype=np.int64)
        often = np.isin(context, _often(self.often, length - 1))
        for name, here in ((f"context-{length}", ~often), (f"often-{length}", often)):
            own = np.flatnonzero(here)
            for s, place, rows in self.lookup(shard_of(context[own], self.shards), context[own], name):
                for i, part in enumerate(("-total", "-one", "-two", "-more")):
                    out[own[rows], i] = self.values(name, s, part, place)
        return out

    def counts(self, length: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        key = gram(context, word)
        out = np.zeros(len(key), dtype=np.int64)
        by = sharded_by(context, key, _often(self.often, length - 1))
        for s, place, rows in self.lookup(shard_of(by, self.shards), key, f"gram-{length}"):
            n = self.values(f"count-{length}", s, "", place)
            if len(full := np.flatnonzero(n == 255)):
                big = _map(self.folder, f"big-{length}-{s}")
                n[full] = _map(self.folder, f"bigcount-{length}-{s}")[np.searchsorted(big, key[rows[full]])]
            out[rows] = n
        return out

    def score(self, h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count in training, log10 probability) of each token."""
        known, back = np.unique(h, return_inverse=True)
        count, before = self.words(known)
        uniform = 1 / (self.types + 1)
        if self.pairs:
            p = less(before, self.taken[1]) / self.pairs + self.rest / self.pairs * uniform
        else:
            p = np.full(len(known), uniform)
        p = p[back]
        for length, c in enumerate(contexts(h, text, self.order - 1)[1:], 2):
            own, at = np.unique(c, return_inverse=True)
            sums = self.sums(length, own)
            seen = sums[at, 0] > 0
            if seen.any():
                taken = self.taken[length]
                rest = sums[:, 1:] @ np.array(taken)
                n = self.counts(length, c[seen], h[seen])
                p[seen] = (less(n, taken) + rest[at[seen]] * p[seen]) / sums[at[seen], 0]
        return count[back], np.log10(p)


def train(spark: SparkSession, texts: DataFrame, order: int) -> Model:
    """Count the one text column of ``texts`` and store the model of n-grams of ``order`` words."""
    if order < 2:
        raise ValueError("the order is two or more")
    ship(spark)
    folder = shared_folder(spark, "kneser-ney")
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    common = texts.mapInArrow(_frequent_contexts(order), "words long, context long, n long, tokens long").groupBy(
        "words", "context").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    total = F.lit(common.agg(F.sum("tokens")).first()[0] or 0)
    # contexts of at least 1/4000 of all tokens, so 4000 rows of each length at most
    often: dict[int, list[int]] = {}
    for r in common.where(F.col("n") * 2 * FREQUENT >= total).where("n > 0").select("words", "context").collect():
        often.setdefault(r["words"], []).append(r["context"])
    often = {words: sorted(own) for words, own in often.items()}
    sent = texts.mapInArrow(_first_grams(order, shards, often), SENT)
    for length in range(order, 0, -1):
        # one shard to a task, whatever the session's number of partitions
        dealt = sent.repartitionById(shards, F.col("shard")).groupBy("shard")
        if length > 1:
            step = _Step(folder, length, order, shards, often)
            sent = dealt.applyInArrow(_task(step), SENT)
        else:
            last = _Words(folder, length, order, shards, often)
            tally = dealt.applyInArrow(_task(last), TALLIES).groupBy("length").agg(
                *(F.sum(x).alias(x) for x in ("n1", "n2", "n3", "n4", "more", "types", "total"))).collect()
    by_length = {r["length"]: r for r in tally}
    taken = {k: discounts(*(r[x] for x in ("n1", "n2", "n3", "n4"))) for k, r in by_length.items() if k}
    one, words = by_length.get(1), by_length.get(0)
    rest = taken[1][0] * one["n1"] + taken[1][1] * one["n2"] + taken[1][2] * (one["n3"] + one["n4"] + one["more"]) if one else 0.0
    return Model(folder, order, shards, often, words["total"] if words else 0, words["types"] if words else 0,
                 one["total"] if one else 0, taken, rest)


def _task(step):
    @released
    def run(group: pa.Table) -> pa.Table:
        return step(group)
    return run


def _scores(model: Model):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    @released
    def run(batches):
        for batch, lo, hi, h, text in tokens(batches, 2, SCORED):
            count, p = model.score(h, text)
            at, n = text - lo, hi - lo
            base = np.log10((count + 0.1) / (model.total + 0.1 * (model.types + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n),
                 pa.array(np.bincount(at, minlength=n)),
                 pa.array(np.bincount(at, weights=count > 0, minlength=n).astype(np.int64)),
                 pa.array(np.full(n, model.total)), pa.array(np.bincount(at, weights=base, minlength=n)),
                 pa.array(np.bincount(at, weights=p, minlength=n))], names=names)
    return run


def score_texts(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, token counts, base score and the model's score of each row."""
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _scores(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double")


def op3_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", (check % 10 == 0).alias("held_out"), "text")
    model = train(spark, docs.where("not held_out").select("text"), ORDER)
    return score_texts(spark, docs, model).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
