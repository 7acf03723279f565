"""Periodic run detection over words: multi-scale minimizers and direct lag scans.

A run is a longest stretch of words with smallest period q that holds at least
two periods. Words are compared exactly (dictionary codes of a slice of texts,
all texts of a slice in one array with a separator of its own after each).

* *Short periods* (below ``SHORT``): one scan for each lag, stretches of equal
  words at that lag.
* *Scales* 2**j from ``SHORT`` on find the periods 2**j <= q < 2**(j+1). In
  every window of 2**j words the smallest hash of a k-gram (k a quarter of the
  window) is a minimizer. A run's first period comes back q words later, so its
  minimizers do too: equal minimizers at a distance that fits the scale are
  seeds, and comparing words to both sides of a seed at its lag gives the run.
* K-grams that are periodic themselves (period up to k/2) are no minimizers, so
  one k-gram has at most a few partners in reach and seeds stay linear. If all
  k-grams of a run's first period are periodic, that period lies inside one run
  of a shorter period d, and the next period inside another run of period d that
  starts within d words of the first one's end. Such neighbours are known from
  smaller scales; they fix the ends of every run that spans them (``_bridges``).
* The smallest period counts: of stretches with the same ends the first stays.

Null and empty texts have no words and no runs. A null doc_id has the checksum
of the empty text. Each row is judged by itself, repeated rows too. Ties for
the longest run go to the smallest start, then the smallest period. A text is
read whole: a task holds one slice of texts (``common.SLICE_BYTES``) or one
longer text. Extra columns are not read.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, released, ship, slices, table
from .textcore import U, mix, powers

#: Shortest run, and periods below which every lag is scanned.
LEAST = 12
SHORT = 32
_NO_KEY = U(0xFFFFFFFFFFFFFFFF)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


def _smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Of the stretches with the same ends the one with the smallest period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
    return start[first], end[first], period[first]


def _minimizers(key: np.ndarray, window: int) -> np.ndarray:
    """Places of the leftmost smallest key of each run of ``window`` keys; none where no key is."""
    n = len(key)
    if n < window:
        return np.zeros(0, dtype=np.int64)
    # the hash's upper bits, then the place: equal stretches still agree on their minimizer
    low = U((1 << n.bit_length()) - 1)
    packed = (key & ~low) | np.arange(n, dtype=U)
    padded = np.concatenate((packed, np.full(-n % window + window, _NO_KEY))).reshape(-1, window)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    since = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    begin = np.arange(n - window + 1)
    at = np.unique((np.minimum(since[begin], upto[begin + window - 1]) & low).astype(np.int64))
    return at[key[at] != _NO_KEY]


def _keys(x: np.ndarray, separator: np.ndarray, k: int, found) -> np.ndarray:
    """Hash of each k-gram; no key where it crosses a separator or has a period up to k/2."""
    n = len(x) - k + 1
    h = np.zeros(n, dtype=U)
    codes, pw = mix(x.astype(U) + U(1)), powers(k)
    # doubling: hash of 2m words from two hashes of m words
    part, size, at, left = codes, 1, 0, k
    while left:
        if left & 1:
            h += part[at:at + n] * pw[at]
            at += size
        left >>= 1
        if left:
            part = part[:len(part) - size] + part[size:] * powers(size + 1)[size]
            size *= 2
    gone = np.zeros(n + 1, dtype=np.int64)
    inside = np.flatnonzero(separator)
    np.add.at(gone, np.clip(inside - k + 1, 0, n), 1)
    np.add.at(gone, np.minimum(inside + 1, n), -1)
    start, end, period = found
    dull = (period * 2 <= k) & (end - start >= k)
    np.add.at(gone, np.minimum(start[dull], n), 1)
    np.add.at(gone, np.minimum(end[dull] - k + 1, n), -1)
    key = mix(h)
    key[key == _NO_KEY] = U(0)
    key[np.cumsum(gone[:-1]) > 0] = _NO_KEY
    return key


def _seeds(at: np.ndarray, key: np.ndarray, text: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal minimizers of one text at lags from ``low`` to below its double."""
    order = np.lexsort((at, key[at], text[at]))
    p, h, t = at[order], key[at][order], text[at][order]
    places, lags = [], []
    step = 1
    while step < len(p):
        lag = p[step:] - p[:-step]
        same = (h[step:] == h[:-step]) & (t[step:] == t[:-step]) & (lag < 2 * low)
        if not same.any():
            break
        hit = np.flatnonzero(same & (lag >= low))
        places.append(p[hit])
        lags.append(lag[hit])
        step += 1
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(lags)


def _reach(x: np.ndarray, a: int, b: int, limit: int) -> int:
    """Equal words from a and b on, ``limit`` at most."""
    done, size = 0, 64
    while done < limit:
        size = min(size, limit - done)
        differ = np.flatnonzero(x[a + done:a + done + size] != x[b + done:b + done + size])
        if len(differ):
            return done + int(differ[0])
        done += size
        size *= 2
    return limit


def _reach_back(x: np.ndarray, a: int, b: int) -> int:
    """Equal words before a and b (a < b)."""
    done, size = 0, 64
    while done < a:
        size = min(size, a - done)
        differ = np.flatnonzero(x[a - done - size:a - done] != x[b - done - size:b - done])
        if len(differ):
            return done + size - 1 - int(differ[-1])
        done += size
        size *= 2
    return a


def _extended(x: np.ndarray, place: np.ndarray, lag: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Stretches with period ``lag`` around the seeds, if they hold two periods."""
    # the left copy has at least ``lag`` words, so it reaches half of the rest on one side
    half = np.maximum((lag - k) // 2, 0)
    may = np.zeros(len(place), dtype=bool)
    for side in (-1, 1):
        ok = np.ones(len(place), dtype=bool)
        for part in (4, 2, 1):
            i = place + side * (half // part) if side < 0 else place + k - 1 + half // part
            inside = (i >= 0) & (i + lag < len(x))
            j = np.where(inside, i, 0)
            ok &= inside & (x[j] == x[np.where(inside, i + lag, 0)])
        may |= ok
    order = np.lexsort((place[may], lag[may]))
    out, last, done = [], -1, -1
    for m, q in zip(place[may][order].tolist(), lag[may][order].tolist()):
        if q == last and m < done:
            continue
        right = _reach(x, m, m + q, len(x) - m - q)
        left = _reach_back(x, m, m + q)
        last, done = q, m + right
        if left + right >= q:
            out.append((m - left, m + right + q, q))
    return out


def _bridges(x: np.ndarray, found, low: int) -> list[tuple[int, int, int]]:
    """Runs with periods from ``low`` to below its double whose first and second
    period lie in two neighbouring runs of one short period d (8 d <= ``low``)."""
    start, end, period = found
    use = (period * 8 <= low) & (end - start >= low)
    start, end, period = start[use], end[use], period[use]
    out: list[tuple[int, int, int]] = []
    for d in np.unique(period).tolist():
        own = period == d
        order = np.argsort(start[own])
        s, e = start[own][order].tolist(), end[own][order].tolist()
        for a, b, c, f in zip(s, e, s[1:], e[1:]):
            if not b - d < c <= b:
                continue
            root = x[c:c + d]
            shift = next((r for r in range(d) if np.array_equal(x[a + r:a + r + d], root)), None)
            if shift is None:
                continue
            q = np.arange(low, min(2 * low, max(b - a, f - c) + 1))
            q = q[(q - (c - a - shift)) % d == 0]
            first, last = np.maximum(a, c - q), np.minimum(f, b + q)
            # one that goes on has more than neighbours in its first period: seeds find it
            ok = (last - first >= 2 * q) & (x[last] != x[last - q]) & ((first == 0) | (x[first - 1] != x[first - 1 + q]))
            out += zip(first[ok].tolist(), last[ok].tolist(), q[ok].tolist())
    return out


def find_runs(x: np.ndarray, text: np.ndarray, sizes: np.ndarray, short: int = SHORT):
    """(start, end, period) of all stretches of two periods and more, smallest period each.

    ``x`` holds the word codes of several texts, each followed by a separator
    that occurs nowhere else; ``text`` is the text of each place, ``sizes`` the
    words of each text.
    """
    starts, ends, periods = [], [], []
    longest = int(sizes.max(initial=0))
    for q in range(1, min(short, longest // 2 + 1)):
        a, b = _stretches(x[q:] == x[:-q])
        long = b - a >= q
        starts.append(a[long])
        ends.append(b[long] + q)
        periods.append(np.full(int(long.sum()), q))
    none = np.zeros(0, dtype=np.int64)
    found = _smallest(*(np.concatenate([none, *v]).astype(np.int64) for v in (starts, ends, periods)))
    low = short
    while 2 * low <= longest:
        # texts with room for two periods of this scale, one after the other
        here = sizes[text] >= 2 * low
        back = np.flatnonzero(here)
        y, own = x[back], text[back]
        to = np.cumsum(here) - 1
        inside = here[found[0]]
        known = (to[found[0][inside]], to[found[1][inside] - 1] + 1, found[2][inside])
        k = max(low // 4, 1)
        separator = np.concatenate((own[1:] != own[:-1], [True]))
        key = _keys(y, separator, k, known)
        place, lag = _seeds(_minimizers(key, low - k + 1), key, own, low)
        new = _extended(y, place, lag, k) + _bridges(y, known, low)
        if new:
            a, b, q = (np.array(v, dtype=np.int64) for v in zip(*new))
            found = _smallest(*(np.concatenate(v) for v in zip(found, (back[a], back[b - 1] + 1, q))))
        low *= 2
    return found


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("period", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("n_dropped", pa.int64()), ("collapsed", pa.string())])
RESULT_SQL = ("doc_id long, n_words long, n_runs long, start long, length long, period long, "
              "runs array<struct<start: long, length: long, period: long>>, n_dropped long, collapsed string")


def _planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the repetition that the contract writes into a tenth of the texts."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _run_rows(least: int, plant: bool):
    @released
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            if texts.type != pa.string():
                texts = texts.cast(pa.string())
            ids = batch.column(0).cast(pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for lo, hi in slices(size, SLICE_BYTES):
                yield _slice_rows(ids.slice(lo, hi - lo), pc.fill_null(texts.slice(lo, hi - lo), ""), least, plant)
    return run


def _slice_rows(ids: pa.Array, texts: pa.Array, least: int, plant: bool) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(texts)
    words, offsets = split.flatten(), split.offsets.to_numpy()
    offsets = offsets - offsets[0]
    real = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(real)))
    first = before[offsets].astype(np.int64)  # words of text i are first[i] .. first[i + 1]
    words = words.filter(pa.array(real))
    sizes = np.diff(first)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    take = np.arange(len(words))
    if plant:
        for i, (d, n) in enumerate(zip(ids.to_pylist(), sizes.tolist())):
            if p := _planted(d, n):
                a, q = p
                own = take[first[i]:first[i + 1]]
                own[a:] = first[i] + a + np.arange(n - a) % q
        codes = codes[take]
    # one separator after each text
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    last = first[1:] + np.arange(len(sizes))
    x = np.empty(len(codes) + len(sizes), dtype=np.int64)
    word = np.ones(len(x), dtype=bool)
    word[last] = False
    x[word] = codes
    x[last] = len(coded.dictionary) + np.arange(len(sizes))
    start, end, period = find_runs(x, text, sizes)
    long = end - start >= least
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]

    # kept: not covered by any run after its first period
    gone = np.zeros(len(x) + 1, dtype=np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    keep = (np.cumsum(gone[:-1]) == 0)[word]
    row = text[start]
    length = end - start
    start = start - first[:-1][row] - row
    n_runs = np.bincount(row, minlength=len(sizes))
    at = np.concatenate(([0], np.cumsum(n_runs)))
    best = np.full(len(sizes), -1, dtype=np.int64)
    by_length = np.lexsort((period, start, -length, row))
    has = n_runs > 0
    best[has] = by_length[at[:-1][has]]
    pick = lambda v: pa.array(np.where(has, v[best] if len(v) else 0, 0), mask=~has)
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    kept = pa.ListArray.from_arrays(pa.array(kept_before[first], pa.int32()), words.take(pa.array(take[keep])))
    struct = RESULT.field("runs").type.value_type
    runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(v, pa.int64()) for v in (start, length, period)], fields=list(struct)))
    return pa.RecordBatch.from_arrays([
        ids, pa.array(sizes), pa.array(n_runs), pick(start), pick(length), pick(period), runs,
        pa.array(sizes - np.diff(kept_before[first])), pc.binary_join(kept, " ")], schema=RESULT)


def periodic_runs(spark: SparkSession, docs: DataFrame, least: int = LEAST, plant: bool = False) -> DataFrame:
    """One row a document: its runs of ``least`` words and more, the longest of them, the
    words that repeat (n_dropped) and the text without them, words joined by one space.

    ``plant`` first writes a repetition into a tenth of the texts (by the checksum of
    doc_id), which is how the registered query makes sure of runs of every scale.
    """
    ship(spark)
    return docs.select("doc_id", "text").mapInArrow(_run_rows(least, plant), RESULT_SQL)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(spark, table(spark, sf_dir, "documents"), plant=True)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))))
    return out.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def brute_force(words: list[str], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one text, comparing every word at every lag."""
    n, ends = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and (i, j + q) not in ends:
                ends[i, j + q] = q
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in ends.items() if b - a >= least)
