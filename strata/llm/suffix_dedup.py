"""Suffix-array dedup: remove every byte that lies in a repeated long string.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else in the corpus (same document included, overlaps counted, judged on the
input). Steps:

1. *Anchors.* In every run of ``length`` bytes the leftmost smallest hash of a
   128-byte piece is its anchor. Equal strings have equal anchors at equal
   offsets, so a repeated string has an anchor whose hash occurs twice.
2. *Probes.* The string starts an anchor can serve are cut into ``RANGES``
   ranges. All strings of one range share a core (from the last start to the
   end of the first string); the segment is all bytes they cover. Segments
   that occur twice are removed whole. Only a segment met once, whose core has
   another segment, needs a comparison.
3. *Hot cores.* Segments are counted by core. If a core has more than
   ``MOST_SEGMENTS`` different ones (the edge of a passage that many texts
   share), the range of each is cut into ``PARTS`` and its parts are probed in
   the same way, with a longer core each. After two rounds a range is a single
   start: its segment is the string itself and the count by segment decides.
4. *Suffix array.* Tasks get the segments by core, write each as a sequence of
   blocks (its core, then the bytes after it in blocks of 16) and sort all
   suffixes of that sequence by linear grouping (``gsaca``). Neighbours in the
   array give the common length after the core; for each start the segments
   of an interval long enough, with the same bytes before the core, are
   repeats of each other.
5. The removed ranges of a text meet its documents by digest.

With ``words`` a call asks for passages instead of strings of one size: strings of
``length`` bytes are found as above, and of the joined ranges of a text those go
that hold over ``words`` whole words or at least ``LENGTH`` bytes.

With ``passage`` a call also counts the words of repeated passages (nothing more is
cut): words in a stretch of ``passage`` whole words that, with the bytes between
them, also starts anywhere else, however few bytes it has. Stretches have anchors as
strings have (the smallest hash of ``PHRASE`` words, from the same pass). A stretch
inside a string that was found twice is a repeat; the other ones whose anchor occurs
twice are counted by their hashes, together with all stretches of their anchor.

Copies of a text count once with their number, segments that a text repeats
are cut within it, and identical segments are counted together (map-side sums),
so a large group of copies is a few rows. What meets in one task are at most ``MOST_SEGMENTS`` *different* segments with one core, that is
with at least ``length - ceil(window starts / RANGES) + 1`` equal bytes.

Null and empty texts keep nothing and lose nothing. Repeated rows (also of one
doc_id) are copies of each other. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, released, ship, slices, stored, table, text_digest, utf8
from .gsaca import suffix_array
from .textcore import VISIBLE, U, Words, mix, powers

LENGTH = 400
WORD = "[^ \\t\\n\\x0B\\f\\r]+"
RANGES = 6
BLOCK = 16
#: Symbols of one suffix array, and one core's segments on top.
ARRAY_SYMBOLS = 1 << 16
#: Different segments of one core that meet in a task; the ranges of a core with
#: more are cut into PARTS.
MOST_SEGMENTS = 1 << 13
PARTS = 8
#: Whole words of a passage ("over fifty words"), and of its anchor.
PASSAGE = 51
PHRASE = 8
CUT_BYTES = 1 << 20
_POS = U((1 << 24) - 1)
_inverse = np.ones(1, dtype=U)


def piece_size(length: int) -> int:
    """Bytes of an anchor: shorter ones recur by chance, longer ones are denser."""
    return max(1, length * 8 // 25)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        a = np.full(max(n, 1024), U(pow(int(powers(2)[1]), -1, 1 << 64)), dtype=U)
        a[0] = 1
        _inverse = np.multiply.accumulate(a)
    return _inverse[:n]


def _smallest(h: np.ndarray, begin: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost smallest of the ``w`` hashes from each begin on."""
    key = (h & ~_POS) | np.arange(len(h), dtype=U)
    pad = np.full(-len(key) % w + w, U(0xFFFFFFFFFFFFFFFF), dtype=U)
    rows = np.concatenate((key, pad)).reshape(-1, w)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(since[begin], upto[begin + w - 1]) & _POS).astype(np.int64)


def _begins(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each piece, ``count`` of them."""
    return np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _sums(joined: bytes) -> np.ndarray:
    buf = np.frombuffer(joined, dtype=np.uint8).astype(U) + U(1)
    return np.concatenate(([U(0)], np.cumsum(buf * powers(len(joined)), dtype=U)))


def anchors(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece number, position, hash) of the anchors of all ``length``-byte runs."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    first = np.cumsum(sizes) - sizes
    joined = b"".join(pieces)
    n, piece = len(joined), piece_size(length)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none
    total = _sums(joined)
    h = mix((total[piece:] - total[:-piece]) * _inverse_powers(n)[:n - piece + 1])
    begin = _begins(first, np.maximum(sizes - length + 1, 0))
    at = np.unique(_smallest(h, begin, length - piece + 1))
    own = np.searchsorted(first, at, "right") - 1
    return own, at - first[own], h[at].view(np.int64)


def stretches(pieces: list[bytes], passage: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the pieces and, of each stretch of ``passage`` words, its first
    word, and place (a word) and hash of its anchor."""
    words = Words(pieces, False, VISIBLE)
    begin = _begins(words.count_before[:-1], np.maximum(words.n - passage + 1, 0))
    none = np.zeros(0, dtype=np.int64)
    if not len(begin):
        return words, none, none, none
    k = min(PHRASE, passage)
    total = _sums(words.buf.tobytes())
    start, end = words.start[:len(words.start) - k + 1], words.end[k - 1:]
    h = mix((total[end] - total[start]) * _inverse_powers(len(words.buf))[start])
    at = _smallest(h, begin, passage - k + 1)
    return words, begin, at, h[at].view(np.int64)


def _word_parts(t: bytes, passage: int) -> list[tuple[int, int]]:
    """Byte ranges of a text in which every stretch of ``passage`` words lies whole in one, once."""
    if len(t) <= CUT_BYTES:
        return [(0, len(t))]
    words = Words([t], False, VISIBLE)
    out, i, n = [], 0, len(words.start)
    while i + passage <= n:
        # stretches that begin within the next bytes
        j = max(int(np.searchsorted(words.start, words.start[i] + CUT_BYTES)), i + 1)
        last = min(j + passage - 2, n - 1)
        out.append((int(words.start[i]), int(words.end[last])))
        i = j
    return out


def _anchor_rows(length: int, passage: int | None):
    cut = CUT_BYTES  # a longer text is read in overlapping parts; every run lies whole in one

    def batch_of(digest, row, h, phrase):
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (h[1:] != h[:-1]))))
        return pa.RecordBatch.from_arrays(
            [digest.take(pa.array(row[first])), pa.array(h[first]), pa.array(np.diff(np.append(first, len(h)))),
             pa.array(np.full(len(first), phrase))], names=["digest", "hash", "n", "phrase"])

    @released
    def run(batches):
        for batch in batches:
            digest, texts = batch.column(0), utf8(batch.column(1))
            parts = [(i, a) for i, t in enumerate(texts) if len(t) >= length for a in range(0, max(len(t) - length + 1, 1), cut)]
            size = [min(len(texts[i]) - a, cut + length - 1) for i, a in parts]
            for lo, hi in slices(size):
                own = parts[lo:hi]
                p, _, h = anchors([texts[i][a:a + cut + length - 1] for i, a in own], length)
                if len(h):
                    yield batch_of(digest, np.array([i for i, _ in own])[p], h, False)
            if passage is None:
                continue
            parts = [(i, a, b) for i, t in enumerate(texts) if len(t) >= 2 * passage - 1 for a, b in _word_parts(t, passage)]
            for lo, hi in slices([b - a for _, a, b in parts]):
                own = parts[lo:hi]
                words, _, at, h = stretches([texts[i][a:b] for i, a, b in own], passage)
                if len(h):
                    # an anchor that two parts of a text share counts twice: only one candidate more
                    at, one = np.unique(at, return_index=True)
                    yield batch_of(digest, np.array([i for i, *_ in own])[words.text[at]], h[one], True)
    return run


WINDOW_SQL = ("anchor long, open boolean, digest binary, copies long, "
              "places array<struct<first: int, stretch: long>>")


def _window_rows(passage: int):
    """The stretches of each wanted anchor of a text by their hash and first byte, those that are
    not yet known to be repeats (open) apart. All stretches of a text with copies are known."""
    @released
    def run(batches):
        place = pa.struct([("first", pa.int32()), ("stretch", pa.int64())])
        schema = pa.schema([("anchor", pa.int64()), ("open", pa.bool_()), ("digest", pa.binary()),
                            ("copies", pa.int64()), ("places", pa.list_(place))])

        def rows(out):
            anchor, is_open, digest, copies, count, first, stretch = zip(*out, strict=True)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(first), pa.int32()),
                                               pa.array(np.concatenate(stretch), pa.int64())], fields=list(place))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *count]), pa.int32()), flat)
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(is_open), pa.array(digest, pa.binary()),
                 pa.array(copies, pa.int64()), lists], schema=schema)

        for batch in batches:
            digests, texts, wanted, copies, cuts = (
                batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(),
                batch.column(3).to_pylist(), _cut_arrays(batch.column(4)))
            out, held = [], 0
            for digest, t, hashes, c, gone in zip(digests, texts, wanted, copies, cuts, strict=True):
                hashes = np.array(hashes, dtype=np.int64)
                for lo, hi in _word_parts(t, passage):
                    words, begin, at, h = stretches([t[lo:hi]], passage)
                    use = np.isin(h, hashes)
                    begin, at, h = begin[use], at[use], h[use]
                    if not len(begin):
                        continue
                    a, b = words.start[begin] + lo, words.end[begin + passage - 1] + lo
                    fresh = np.full(len(a), False) if c > 1 else ~within(a, b, *gone)
                    key = np.fromiter((xxhash.xxh3_64_intdigest(t[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)),
                                      dtype=U, count=len(a)).view(np.int64)
                    order = np.lexsort((a, fresh, h))
                    h, fresh, a, key = h[order], fresh[order], a[order], key[order]
                    edge = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (fresh[1:] != fresh[:-1]))))
                    for x, y in zip(edge.tolist(), [*edge[1:].tolist(), len(h)], strict=True):
                        out.append((int(h[x]), bool(fresh[x]), digest, min(c, 2), y - x, a[x:y], key[x:y]))
                    held += len(h)
                    if held > 500_000:
                        yield rows(out)
                        out, held = [], 0
            if out:
                yield rows(out)
    return run


def _cut_arrays(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first, last) of the ranges of each row, none for null."""
    if pa.types.is_null(column.type):
        return [(np.zeros(0, dtype=np.int64),) * 2] * len(column)
    flat = column.flatten()
    first, last = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    end = np.cumsum([n or 0 for n in column.value_lengths().to_pylist()], dtype=np.int64)
    return [(first[x:y], last[x:y]) for x, y in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]


def within(a: np.ndarray, b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether each stretch lies in a single one of the ranges, with the bytes beside it:
    without them its first or last word may be part of a longer one at the other place."""
    if not len(first):
        return np.full(len(a), False)
    order = np.argsort(first, kind="stable")
    reach = np.maximum.accumulate(last[order])
    i = np.searchsorted(first[order], a - 1, "right") - 1
    return (i >= 0) & (reach[np.maximum(i, 0)] > b)


def passage_words(t: bytes, passage: int, cuts: tuple[np.ndarray, np.ndarray], starts: list[int] | None) -> int:
    """Words in stretches that lie in one of the repeated strings or begin at one of the starts."""
    n, upto = 0, 0  # upto: first byte behind the words counted
    for lo, hi in _word_parts(t, passage):
        words = Words([t[lo:hi]], False, VISIBLE)
        first = np.arange(max(len(words.start) - passage + 1, 0))
        a, b = words.start[first] + lo, words.end[first + passage - 1] + lo
        hit = first[within(a, b, *cuts) | np.isin(a, starts or [])]
        step = np.zeros(len(words.start) + 1, dtype=np.int64)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + passage, -1)
        covered = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        # the last words of a part are the first ones of the next
        covered = covered[words.start[covered] + lo >= upto]
        n += len(covered)
        if len(covered):
            upto = int(words.end[covered[-1]]) + lo
    return n


def _anchor_places(t: bytes, length: int, hashes: list[int]) -> list[int]:
    """Places of the anchors of one text that have one of the hashes."""
    wanted, out, cut = np.array(hashes, dtype=np.int64), [], 1 << 20
    for a in range(0, max(len(t) - length + 1, 1), cut):
        _, at, h = anchors([t[a:a + cut + length - 1]], length)
        out.append(at[np.isin(h, wanted)] + a)
    return np.unique(np.concatenate(out)).tolist()


def _ranges(length: int) -> list[tuple[int, int]]:
    """First and last start of each range, relative to the anchor."""
    starts = np.array_split(np.arange(piece_size(length) - length, 1), RANGES)
    return [(int(x[0]), int(x[-1])) for x in starts]


def merged(ranges) -> list[list[int]]:
    """Joined (first, end) ranges in order."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return runs


def _probe_rows(length: int):
    """A row for each different segment of a text; a segment that the text
    itself repeats is cut at once (rows without a core: first and size)."""
    spans = _ranges(length)

    @released
    def run(batches):
        for batch in batches:
            digests = batch.column(0).to_pylist()
            texts, found, copies = utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            out: list[tuple] = []
            for digest, t, hashes, c in zip(digests, texts, found, copies, strict=True):
                n = len(t)
                own: dict[tuple, tuple] = {}
                cuts = []
                for p in _anchor_places(t, length, hashes):
                    for j, (lo, hi) in enumerate(spans):
                        first, last = max(p + lo, 0), min(p + hi, n - length)
                        if first > last:
                            continue
                        whole = t[first:last + length]
                        # strings are compared at one place before the core: it is part of the segment
                        key = (j, xxhash.xxh3_128_digest(whole, seed=p + hi - first), p + hi - first)
                        if key in own:
                            seen = own[key]
                            cuts += [(seen[3], seen[3] + seen[4]), (first, first + len(whole))]
                            own[key] = (*seen[:7], 2)
                        else:
                            core = xxhash.xxh3_64_intdigest(t[p + hi:p + lo + length], seed=j) - (1 << 63)
                            own[key] = (core, key[1], digest, first, len(whole), p + hi - first,
                                        p + lo + length - first, min(c, 2))
                out += own.values()
                if c == 1:  # a text with copies goes as a whole
                    out += [(None, None, digest, a, b - a, None, None, None) for a, b in merged(cuts)]
                if len(out) > 50_000:
                    yield _batch(out, PROBE)
                    out = []
            if out:
                yield _batch(out, PROBE)
    return run


PROBE = pa.schema([("core", pa.int64()), ("segment", pa.binary()), ("digest", pa.binary()), ("first", pa.int32()),
                   ("size", pa.int32()), ("core_first", pa.int32()), ("core_end", pa.int32()), ("copies", pa.int64())])
PROBE_SQL = ("core long, segment binary, digest binary, first int, size int, core_first int, core_end int, "
             "copies long")
CUT_SQL = "digest binary, first int, last int"
CUT = pa.schema([("digest", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows), schema, strict=True)],
                                      schema=schema)


def _part_rows(length: int):
    """Probe rows of the parts of the wanted segments (one array per text)."""
    @released
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for digest, t, want in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(),
                                       strict=True):
                for x in want:
                    begin, end = x["first"], x["first"] + x["size"] - length
                    lo, hi = x["first"] + x["core_end"] - length, x["first"] + x["core_first"]
                    for k, part in enumerate(np.array_split(np.arange(lo, hi + 1), PARTS)):
                        if not len(part):
                            continue
                        a, b = int(part[0]), int(part[-1])
                        first, last = max(a, begin), min(b, end)
                        if first > last:
                            continue
                        # the hash goes on from the core's: only the same part of one core meets
                        core = xxhash.xxh3_64_intdigest(t[b:a + length], seed=x["core"] + (1 << 63) ^ k) - (1 << 63)
                        segment = xxhash.xxh3_128_digest(t[first:last + length], seed=b - first)
                        out.append((core, segment, digest, first, last + length - first, b - first,
                                    a + length - first, min(x["times"], 2)))
                if len(out) > 50_000:
                    yield _batch(out, PROBE)
                    out = []
            if out:
                yield _batch(out, PROBE)
    return run


@released
def _segment_rows(batches):
    """Cut the wanted segments (one array per text) out of their texts."""
    schema = pa.schema([("core", pa.int64()), ("digest", pa.binary()), ("first", pa.int32()), ("times", pa.int64()),
                        ("before", pa.binary()), ("middle", pa.binary()), ("after", pa.binary())])
    for batch in batches:
        out = []
        for digest, t, want in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(),
                                   strict=True):
            for x in want:
                s = t[x["first"]:x["first"] + x["size"]]
                a, b = x["core_first"], x["core_end"]
                out.append((x["core"], digest, x["first"], x["times"], s[:a], s[a:b], s[b:]))
            if len(out) > 20_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)


def repeats(group: list[int], before: list[bytes], core: list[bytes], after: list[bytes], times: np.ndarray,
            length: int) -> list[tuple[int, int]]:
    """(segment, bytes before its core) of each string that another place has too.

    Segments may have different cores, and only those of one group are compared:
    in another group the same place can have the same core; string t of a segment is its last t
    bytes before the core, the core, and what is missing to ``length`` after.
    """
    n = len(core)
    per = [[a[i:i + BLOCK] for i in range(0, len(a), BLOCK)] for a in after]
    rank = {x: i + 1 for i, x in enumerate(sorted({b for p in per for b in p}))}
    cores = list(zip(group, core, strict=True))
    middles = {x: i + 1 + len(rank) for i, x in enumerate(sorted(set(cores)))}
    symbols, at = [], np.empty(n, dtype=np.int64)
    for i in range(n):
        at[i] = len(symbols)
        symbols.append(middles[cores[i]])
        symbols.extend(rank[b] for b in per[i])
        symbols.append(0)
    sa = suffix_array(np.array(symbols, dtype=np.int64))
    segment_at = np.full(len(symbols), -1, dtype=np.int64)
    segment_at[at] = np.arange(n)
    order = segment_at[sa]
    order = order[order >= 0]

    longest = max((length - len(c) for c in core), default=0)
    kind = np.array([middles[c] for c in cores])[order]
    need = np.array([length - len(c) for c in core])[order]
    have_l, have_r = np.array([len(x) for x in before])[order], np.array([len(x) for x in after])[order]
    right = np.full((n, longest + 1), -1, dtype=np.int16)
    left = np.full((n, longest + 1), -1, dtype=np.int16)
    for row, i in enumerate(order):
        a, b = after[i][:longest], before[i][::-1][:longest]
        right[row, :len(a)] = np.frombuffer(a, dtype=np.uint8)
        left[row, :len(b)] = np.frombuffer(b, dtype=np.uint8)
    same = (right[1:] == right[:-1]) & (right[1:] >= 0)
    common = np.where(kind[1:] == kind[:-1], np.argmin(same, axis=1), -1)
    tail = np.zeros(n, dtype=U)
    found: list[tuple[int, int]] = []
    weight = times[order]
    for t in range(longest + 1):
        if t:
            tail = mix(tail * U(31) + left[:, t - 1].astype(U) + U(7))
        ok = np.flatnonzero((have_l >= t) & (have_r >= need - t) & (need >= t))
        if not len(ok):
            continue
        cluster = np.concatenate(([0], np.cumsum(common < np.maximum(need[1:] - t, 0))))
        key = np.stack((cluster[ok].view(U), tail[ok]), axis=1)
        _, back = np.unique(mix(key[:, 0] * U(0x9E3779B97F4A7C15) + key[:, 1]), return_inverse=True)
        twice = np.bincount(back, weights=weight[ok])[back] >= 2
        found += [(int(order[r]), t) for r in ok[twice]]
    return found


def _array_rows(length: int):
    def solve(rows):
        # a row of the documents may be there twice; segments cut off at a text's
        # start share their first byte, so the bytes around the core count too
        rows = {(*x[:3], len(x[4]), len(x[6])): x for x in rows}.values()
        core, digest, first, times, before, middle, after = zip(*rows, strict=True)
        hit = repeats(list(core), list(before), list(middle), list(after), np.array(times), length)
        out = []
        for i, t in hit:
            if times[i] < 2:
                start = first[i] + len(before[i]) - t
                out.append((digest[i], start, start + length))
        return out

    @released
    def run(batches):
        held: list[tuple] = []
        count = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if count > ARRAY_SYMBOLS and row[0] != held[-1][0]:
                    if out := solve(held):
                        yield _batch(out, CUT)
                    held, count = [], 0
                held.append(row)
                count += 3 + len(row[6]) // BLOCK
        if held and (out := solve(held)):
            yield _batch(out, CUT)
    return run


def whole_words(t: bytes, a: int, b: int) -> int:
    """Words [^\\x20\\x09-\\x0D]+ of a text that lie wholly in a range."""
    n = len(t[a:b].split())
    inside = lambda at: 0 < at < len(t) and not t[at - 1:at].isspace() and not t[at:at + 1].isspace()
    return max(n - inside(a) - inside(b), 0)


def _kept_rows(words: int | None, passage: int | None):
    """(digest, n_removed, spans, kept, n_passage_words) of texts with ranges to cut or repeated stretches."""
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    @released
    def run(batches):
        for batch in batches:
            gone, spans, kept, counted = [], [], [], []
            for t, ranges, starts in zip(utf8(batch.column(1)), _cut_arrays(batch.column(2)), batch.column(3).to_pylist(),
                                         strict=True):
                counted.append(None if passage is None else passage_words(t, passage, ranges, starts))
                runs = merged(zip(*(x.tolist() for x in ranges), strict=True))
                if words is not None:
                    runs = [(a, b) for a, b in runs if b - a >= LENGTH or whole_words(t, a, b) > words]
                at, parts = 0, []
                for a, b in runs:
                    parts.append(t[at:a])
                    at = b
                parts.append(t[at:])
                gone.append(sum(b - a for a, b in runs))
                spans.append([{"first": a, "last": b} for a, b in runs])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()),
                 pa.array(counted, pa.int64())], names=["digest", "n_removed", "spans", "kept", "n_passage_words"])
    return run


KEPT = "digest binary, n_removed long, spans array<struct<first: int, last: int>>, kept binary, n_passage_words long"


def _passages(spark: SparkSession, chosen: DataFrame, cuts: DataFrame, passage: int) -> DataFrame:
    """(digest, starts): first bytes of the repeated stretches of ``passage`` words that lie in no cut."""
    rows = stored(spark, chosen.where(F.size("phrases") > 0).select("digest", "text", "phrases", "copies").join(
        cuts, "digest", "left").mapInArrow(_window_rows(passage), WINDOW_SQL), "dedup-stretches")
    wanted = rows.where("open").select("anchor").distinct()
    every = rows.join(wanted, "anchor", "left_semi").select("anchor", "open", "digest", "copies", F.inline("places"))
    twice = every.groupBy("anchor", "stretch").agg(F.sum("copies").alias("times")).where("times > 1")
    out = stored(spark, every.where("open").join(twice, ["anchor", "stretch"], "left_semi").groupBy("digest").agg(
        F.collect_list("first").alias("starts")), "dedup-passages")
    discard(spark, rows)
    return out


def _wanted(segments: DataFrame) -> DataFrame:
    """One row a text with the places of the segments that stand for their copies in it."""
    return segments.select(
        F.col("one.digest").alias("digest"),
        F.struct("core", "times", "one.first", "one.size", "one.core_first", "one.core_end").alias("x")).groupBy(
        "digest").agg(F.collect_list("x").alias("want"))


def removals(spark: SparkSession, docs: DataFrame, length: int = LENGTH, words: int | None = None,
             passage: int | None = None) -> DataFrame:
    """For each different text that may lose bytes: its digest, n_removed, spans
    (removed byte ranges) and kept (the remaining bytes); with ``passage`` also each
    with a repeated passage, and n_passage_words."""
    ship(spark)
    least = length if passage is None else min(length, 2 * passage - 1)
    base = docs.where(F.octet_length("text") >= least).select("doc_id", "text", text_digest(F.col("text")).alias("own"))
    texts = stored(spark, base.groupBy("own").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("one"),
        F.max(F.octet_length("text")).alias("size"),
        *([F.max(F.regexp_count("text", F.lit(WORD))).alias("words")] if words is not None else [])), "dedup-texts")

    met = stored(spark, base.select("own", "text").mapInArrow(
        _anchor_rows(length, passage), "digest binary, hash long, n long, phrase boolean"), "dedup-anchors")
    often = met.groupBy("hash", "phrase").agg(F.sum("n").alias("n")).where("n > 1").select("hash", "phrase")
    places = met.join(often, ["hash", "phrase"]).groupBy("digest").agg(
        F.collect_set(F.when(~F.col("phrase"), F.col("hash"))).alias("hashes"),
        F.collect_set(F.when(F.col("phrase"), F.col("hash"))).alias("phrases"))
    # one document stands for all copies of its text
    wanted = texts.join(places, texts["own"] == places["digest"]).select("digest", "copies", "one", "hashes", "phrases")
    chosen = base.join(wanted, (F.col("own") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("one")))
    chosen = stored(spark, chosen.select("digest", "text", "hashes", "phrases", "copies"), "dedup-chosen")
    discard(spark, met)

    rows = stored(spark, chosen.where(F.size("hashes") > 0).select(
        "digest", "text", "hashes", "copies").mapInArrow(_probe_rows(length), PROBE_SQL), "dedup-probes")
    found = [rows.where("core is null").select("digest", "first", (F.col("first") + F.col("size")).alias("last"))]
    done = []
    while True:
        probes = rows.where("core is not null")
        segments = stored(spark, probes.groupBy("core", "segment").agg(
            F.sum("copies").alias("times"),
            F.min(F.struct("digest", "first", "size", "core_first", "core_end")).alias("one")), "dedup-segments")
        found.append(probes.where("copies = 1").join(
            segments.where("times > 1").select("core", "segment"), ["core", "segment"], "left_semi").select(
            "digest", "first", (F.col("first") + F.col("size")).alias("last")))
        cores = stored(spark, segments.groupBy("core").agg(
            F.count(F.lit(1)).alias("kinds"), F.min("times").alias("least")).where(
            "kinds > 1 and least = 1").select("core", "kinds"), "dedup-cores")
        done += [rows, segments, cores]
        hot = cores.where(F.col("kinds") > MOST_SEGMENTS).select("core")
        split = not hot.isEmpty()
        cold = segments.join(hot, "core", "left_anti") if split else segments
        lone = chosen.select("digest", "text").join(
            _wanted(cold.join(cores.select("core"), "core")), "digest").mapInArrow(
            _segment_rows, "core long, digest binary, first int, times long, before binary, middle binary, after binary")
        found.append(lone.repartition("core").sortWithinPartitions("core").mapInArrow(_array_rows(length), CUT_SQL))
        if not split:
            break
        parts = chosen.select("digest", "text").join(
            _wanted(segments.join(hot, "core", "left_semi")), "digest")
        rows = stored(spark, parts.mapInArrow(_part_rows(length), PROBE_SQL), "dedup-parts")
    cuts = stored(spark, reduce(DataFrame.unionByName, found).groupBy("digest").agg(
        F.collect_set(F.struct("first", "last")).alias("cuts")), "dedup-cuts")
    discard(spark, *done)

    single = chosen.where("copies = 1").select("digest", "text")
    if passage is None:
        single = single.join(cuts, "digest").withColumn("starts", F.lit(None).cast("array<int>"))
    else:
        passages = _passages(spark, chosen, cuts, passage)
        single = single.join(cuts.join(passages, "digest", "full"), "digest").select("digest", "text", "cuts", "starts")
    single = single.mapInArrow(_kept_rows(words, passage), KEPT)
    span = "array<struct<first: int, last: int>>"
    all_bytes = F.array(F.struct(F.lit(0).alias("first"), F.col("size").alias("last")))
    if passage is None:
        copied = texts.where("copies > 1")
        if words is not None:
            copied = copied.where((F.col("words") > words) | (F.col("size") >= LENGTH))
        copied = copied.select(
            F.col("own").alias("digest"), F.col("size").cast("long").alias("n_removed"), all_bytes.alias("spans"),
            F.lit(b"").alias("kept"), F.lit(None).cast("long").alias("n_passage_words"))
    else:
        # copies are whole repeats, but below ``length`` bytes nothing is cut
        gone, count = F.col("size") >= length, F.col("n").cast("long")
        size = F.octet_length("text")
        copied = chosen.where("copies > 1").groupBy("digest").agg(  # a row may be there twice
            F.max(size).alias("size"), F.max(F.regexp_count("text", F.lit(WORD))).alias("n"),
            F.max(F.when(size < length, F.col("text"))).alias("text")).select(
            "digest", F.when(gone, F.col("size")).otherwise(0).cast("long").alias("n_removed"),
            F.when(gone, all_bytes).otherwise(F.array().cast(span)).alias("spans"),
            F.when(gone, F.lit(b"")).otherwise(F.col("text").cast("binary")).alias("kept"),
            F.when(count >= passage, count).otherwise(F.lit(0)).alias("n_passage_words"))
    out = stored(spark, single.unionByName(copied), "dedup-removals")
    discard(spark, texts, chosen, cuts, *([passages] if passage is not None else []))
    return out


def suffix_dedup(spark: SparkSession, docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` with n_removed, spans and kept (bytes) of each row's text;
    these replace columns of the same names."""
    gone = removals(spark, docs, length, words).drop("n_passage_words")
    docs = docs.drop("n_removed", "spans", "kept")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), text_digest(F.col("text")).alias("own"))
    none = F.array().cast("array<struct<first: int, last: int>>")
    return rows.join(gone, F.col("own") == F.col("digest"), "left").select(
        "row.*", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("spans", none).alias("spans"),
        F.coalesce("kept", F.col("row.text").cast("binary"), F.lit(b"")).alias("kept"))


def _whole_characters(kept: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, cuts in zip(kept.to_pylist(), spans.to_pylist(), strict=True):
        if t is None:
            out.append(None)
            continue
        parts, at, gone = [], 0, 0
        for x in cuts:
            parts.append(t[at:x["first"] - gone])
            at, gone = x["first"] - gone, gone + x["last"] - x["first"]
        out.append("".join(p.decode("utf-8", "ignore") for p in [*parts, t[at:]]))
    return pa.array(out, pa.string())


def whole_characters(kept, spans):
    """The remaining bytes as text, without what is left of characters that a span's edge cuts in two."""
    return F.arrow_udf(_whole_characters, "string")(kept, spans)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str, passage: int | None = None) -> DataFrame:
    """The columns of the contract; with ``passage`` n_passage_words follows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = removals(spark, docs, passage=passage).select(
        "digest", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha"),
        "n_passage_words")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha"))
    return rows.join(gone, "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha", "whole_sha").alias("kept_sha256"),
        *([F.coalesce("n_passage_words", F.lit(0)).alias("n_passage_words")] if passage is not None else []))


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, str]]:
    """(removed, runs, digest of the rest) of each text, by counting every string."""
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            count[s] = count.get(s, 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((sum(gone), runs, hashlib.sha256(bytes(b for b, x in zip(t, gone, strict=True) if not x)).hexdigest()))
    return out


def brute_passages(texts: list[bytes], passage: int) -> list[int]:
    """Words of each text in stretches of ``passage`` words that also start elsewhere, by counting every stretch."""
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for t in texts]
    stretch = [[t[w[i][0]:w[i + passage - 1][1]] for i in range(len(w) - passage + 1)]
               for t, w in zip(texts, places, strict=True)]
    count: dict[bytes, int] = {}
    for s in (x for own in stretch for x in own):
        count[s] = count.get(s, 0) + 1
    return [len({j for i, s in enumerate(own) if count[s] > 1 for j in range(i, i + passage)}) for own in stretch]
