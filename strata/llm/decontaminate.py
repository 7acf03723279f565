"""Benchmark decontamination: pigeonhole pieces, then Myers bit-parallel distance.

An item is found in a document if the document has a substring within
``budget`` edits of it (a tenth of the item's length), both as lower-case
words joined by single spaces. The parameter ``whole_words`` of both calls says up
to how many bytes of an item the substring must be whole words, so that a short
answer is not found inside a longer word. An item is cut into budget + 1 pieces: with at
most ``budget`` edits one piece is untouched, so an Aho-Corasick automaton of
all pieces finds every place that needs a look; the bytes beside the piece are
looked up and the parts around it compared first, smaller ones with their share
of the budget. Overlapping places of one item
in one document are joined, and Myers' algorithm gives the least distance
over each.

The benchmark is the query set. It is read in blocks of bounded bytes, each
block is one pass over the documents (one for every ``QUERY_BYTES`` of items, all
blocks as broadcasts); documents are never shuffled.

Words are runs of ASCII letters and digits and of non-ASCII characters. Null,
empty and wordless texts and items match nothing. Repeated documents give one
row each; repeated items (same id and text) count once. Of equally near places
the first is reported. Extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, ship, table, text_slices
from .textcore import ALNUM, Words

#: Edits allowed: one for each so many bytes of an item.
BYTES_PER_EDIT = 10
#: Items of up to so many bytes must stand at word edges, if a call does not say otherwise.
WHOLE_WORDS = 30
#: Bytes of benchmark text that one pass carries to the tasks.
QUERY_BYTES = 1 << 20


def normal(texts: list[bytes]) -> tuple[bytes, np.ndarray, Words, np.ndarray]:
    """All texts as words with one space after each; first byte of each text
    in it, the words, and the first byte of each word."""
    w = Words(texts, True, ALNUM)
    size = w.end - w.start
    place = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
    inside = np.repeat(place - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[inside] = w.buf[w._mask]
    first = np.append(place, len(out))[w.count_before]
    return out.tobytes(), first, w, place


@lru_cache(maxsize=20_000)
def bit_masks(text: bytes) -> dict[int, int]:
    """For each byte the places it has in ``text``, as bits."""
    out: dict[int, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Item:
    """One benchmark item and its pieces.

    A part with a budget of k edits is halved into parts with budgets that add
    up to k - 1, down to budget 0: if the part matches, one half matches within
    its own budget. So an untouched piece exists whose enclosing parts all
    match, and a piece hit is followed upwards before the whole is compared.
    """

    def __init__(self, item_id, text: bytes):
        self.id, self.text, self.size = item_id, text, len(text)
        self.budget = self.size // BYTES_PER_EDIT
        #: first byte, end byte, enclosing parts from small to large as (first, end,
        #: budget) and the bytes beside it as (bytes, first and end where they can
        #: stand, from the piece's first byte) of each piece
        self.pieces: list[tuple[int, int, list[tuple[int, int, int]], list[tuple[bytes, int, int]]]] = []
        self._halve(0, self.size, self.budget, [])

    def _halve(self, a: int, b: int, budget: int, parts: list) -> None:
        if budget == 0:
            self.pieces.append((a, b, [x for x in reversed(parts) if x[2] < self.budget], self._beside(a, b, parts)))
            return
        left = (budget - 1) // 2
        cut = a + (b - a) * (left + 1) // (budget + 1)
        self._halve(a, cut, left, [*parts, (a, b, budget)])
        self._halve(cut, b, budget - 1 - left, [*parts, (a, b, budget)])

    def _beside(self, a: int, b: int, parts: list) -> list[tuple[bytes, int, int]]:
        """The rest of the smallest enclosing part in one piece more than its
        budget: if the part matches, one of them stands unchanged near its place."""
        if not parts:
            return []
        first, end, k = parts[-1]
        x, y = (b, end) if first == a else (first, a)
        cut = [x + (y - x) * i // (k + 1) for i in range(k + 2)]
        return [(self.text[p:q], p - a - k, q - a + k) for p, q in zip(cut, cut[1:])]


def least_distance(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edits of ``pattern`` to a substring of ``text`` and its first best end (Myers)."""
    masks, size = bit_masks(pattern), len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(h | up))
        minus = up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, i + 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(v | plus))
        down = plus & v
    return best, end


def distance(a: bytes, b: bytes) -> int:
    """Edits between two short texts as a whole."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def whole_words(item: Item, joined: bytes, spans: list[list[int]], place: np.ndarray) -> tuple[int, int, int] | None:
    """(edits, first, end) of the words in the spans that are nearest to an item, if within its budget."""
    best = None
    for lo, hi in sorted(spans):
        for start in place[np.searchsorted(place, lo):np.searchsorted(place, hi)].tolist():
            limit = min(hi, start + item.size + item.budget)
            end = joined.find(b" ", start + item.size - item.budget, limit + 1)
            while end >= 0:
                part = joined[start:end]
                edits = 0 if part == item.text else distance(item.text, part) if item.budget else 1
                if edits <= item.budget and (best is None or edits < best[0]):
                    best = (edits, start, end)
                    if edits == 0:
                        return best
                end = joined.find(b" ", end + 1, limit + 1)
    return best


def automaton(items: list[Item]):
    at: dict[str, list[tuple[int, int, list, list]]] = {}
    for n, item in enumerate(items):
        for a, b, around, beside in item.pieces:
            at.setdefault(item.text[a:b].decode("latin-1"), []).append((n, a, around, beside))
    found = ahocorasick.Automaton()
    for piece, where in at.items():
        found.add_word(piece, (len(piece), where))
    found.make_automaton()
    return found


def search(a, items: list[Item], texts: list[bytes], short: int = 0):
    """(text, item, edits, first byte, end byte) of the best place of each item found;
    items of up to ``short`` bytes are only found as whole words."""
    joined, first, words, place = normal(texts)
    bounds = first.tolist()
    windows: dict[tuple[int, int], list[list[int]]] = {}
    text = 0
    for end, (size, where) in a.iter(joined.decode("latin-1")):
        while end >= bounds[text + 1]:
            text += 1
        hit = end + 1 - size
        for n, offset, around, beside in where:
            low, high = bounds[text], bounds[text + 1]
            if beside and not any(joined.find(x, max(low, hit + p), max(low, min(high, hit + q))) >= 0 for x, p, q in beside):
                continue
            item = items[n]
            start = hit - offset
            lo = max(bounds[text], start - item.budget)
            hi = min(bounds[text + 1], start + item.size + item.budget)
            if hi - lo < item.size - item.budget:
                continue
            if not all(least_distance(item.text[x:y], joined[max(bounds[text], start + x - k):
                                                             min(bounds[text + 1], start + y + k)])[0] <= k
                       for x, y, k in around):
                continue
            own = windows.setdefault((text, n), [])
            if own and lo <= own[-1][1] and own[-1][0] <= hi:
                own[-1] = [min(lo, own[-1][0]), max(hi, own[-1][1])]
            else:
                own.append([lo, hi])
    for (text, n), spans in windows.items():
        item = items[n]
        base = words.first_byte[text]
        if item.size <= short:
            if best := whole_words(item, joined, spans, place):
                edits, start, end = best
                a_word, b_word = np.searchsorted(place, [start, end])
                yield text, n, edits, int(words.start[a_word] - base), int(words.end[b_word - 1] - base)
            continue
        best = None
        for lo, hi in sorted(spans):
            edits, end = least_distance(item.text, joined[lo:hi])
            if edits <= item.budget and (best is None or edits < best[0]):
                best = (edits, lo + end, lo)
                if edits == 0:
                    break
        if best:
            edits, end, lo = best
            _, size = least_distance(item.text[::-1], joined[lo:end][::-1])
            a_word = int(np.searchsorted(place, end - size, "right")) - 1
            b_word = int(np.searchsorted(place, end - 1, "right")) - 1
            yield text, n, edits, int(words.start[a_word] - base), int(words.end[b_word] - base)


def _finder(shared, whole_words):
    @released
    def run(batches):
        items = [Item(i, t) for i, t in shared.value]
        a = automaton(items)
        for batch in batches:
            for lo, _, texts in text_slices(batch, 1):
                found = list(search(a, items, texts, whole_words))
                if found:
                    t, n, edits, first, end = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([lo + x for x in t])),
                         pa.array([items[x].id for x in n], pa.int64()), pa.array(edits, pa.int32()),
                         pa.array([items[x].budget for x in n], pa.int32()), pa.array(first, pa.int32()),
                         pa.array(end, pa.int32())],
                        names=["doc_id", "item_id", "edits", "budget", "first_byte", "end_byte"])
    return run


FOUND = "doc_id long, item_id long, edits int, budget int, first_byte int, end_byte int"


def item_blocks(spark: SparkSession, benchmark: DataFrame) -> list:
    """The benchmark's items in broadcasts of about QUERY_BYTES of text each."""
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // QUERY_BYTES))
    out = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = [(row["item_id"], normal([row["text"].encode()])[0][:-1]) for row in part]
        rows = sorted({x for x in rows if x[1]}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if rows:
            out.append(spark.sparkContext.broadcast(rows))
    return out


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, whole_words: int = WHOLE_WORDS) -> DataFrame:
    """One row for each (document, item) found: edits, budget, byte span."""
    ship(spark)
    found = [docs.select("doc_id", "text").mapInArrow(_finder(x, whole_words), FOUND) for x in item_blocks(spark, benchmark)]
    out = found[0] if found else spark.createDataFrame([], FOUND)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _clean(shared, whole_words):
    @released
    def run(batches):
        items = [Item(i, t) for i, t in shared.value]
        a = automaton(items)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, _, texts in text_slices(batch, batch.schema.get_field_index("text")):
                for text, *_ in search(a, items, texts, whole_words):
                    keep[lo + text] = False
            yield batch.filter(pa.array(keep))
    return run


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, whole_words: int = WHOLE_WORDS) -> DataFrame:
    """The documents in which no benchmark item is found."""
    ship(spark)
    for block in item_blocks(spark, benchmark):
        docs = docs.mapInArrow(_clean(block, whole_words), docs.schema)
    return docs


def op8_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
