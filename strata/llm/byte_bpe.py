"""Byte-level BPE encoding and decoding with a given rank file.

Texts are cut into pre-tokens by the usual pattern, worked out on arrays of
character classes for a whole batch. Each distinct pre-token of a batch is
resolved in two tiers: a minimal perfect hash finds those that are vocabulary
entries as a whole; the others are merged with a heap of pair ranks over a
doubly linked list of their bytes, and kept in a bounded cache of the worker.

Null texts are empty and give no ids. Texts are valid UTF-8; other bytes would
become replacement characters. Pre-tokens with equal 64-bit hashes count as
equal. Rows are independent of each other, so repeated
rows, ties and copies need no care. Extra columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, ship, table, text_slices
from .textcore import U, mix, powers

#: Entries of a worker's cache of merged pre-tokens.
CACHE = 200_000
OTHER, LETTER, NUMBER, SPACE = range(4)
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Character class of each code point, asked of the tokenizer library, so
    that letters and numbers are those of its edition of Unicode."""
    global _classes
    if _classes is None:
        import tiktoken

        out = np.zeros(0x110000, dtype=np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        single = {bytes((i,)): i for i in range(256)}
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
            own = bytes(found.encode_ordinary(every)).decode()
            out[np.frombuffer(own.encode("utf-32-le"), dtype=np.uint32)] = kind
        _classes = out
    return _classes


def pre_tokens(texts: list[bytes], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, first byte of each pre-token, its text); ``kinds`` are the classes of code points."""
    texts = [t.decode("utf-8", "replace").encode() for t in texts]
    joined = b"".join(texts)
    buf = np.frombuffer(joined, dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if not len(buf):
        return buf, none, none
    byte_at = np.flatnonzero((buf & 0xC0) != 0x80)
    code = np.frombuffer(joined.decode().encode("utf-32-le"), dtype=np.uint32)
    kind = kinds[code]
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_start = np.searchsorted(byte_at, (np.cumsum(size) - size)[size > 0])
    new = np.concatenate(([True], kind[1:] != kind[:-1]))
    new[text_start] = True
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(code))
    k = kind[a]
    first = np.zeros(len(code) + 1, dtype=bool)
    first[text_start] = True
    first[-1] = True
    opens, closes = first[a], first[b]
    space = k == SPACE
    blank = code[b - 1] == 32
    # a run takes the last blank before it
    glue = np.zeros(len(a), dtype=bool)
    glue[1:] = ~space[1:] & space[:-1] & blank[:-1] & ~opens[1:]
    begin = np.where(glue, a - 1, a)
    # contractions: a lone apostrophe and its letters
    shift = np.zeros(len(a), dtype=np.int64)
    lone = np.flatnonzero((code[a] == 39) & (b - a == 1) & ~glue & ~closes)
    lone = lone[k[lone + 1] == LETTER]
    if len(lone):
        s = a[lone + 1]
        room = b[lone + 1] - s
        taken = np.zeros(len(lone), dtype=np.int64)
        for c in _CONTRACTIONS:
            hit = (taken == 0) & (room >= len(c))
            for i, x in enumerate(c):
                hit &= code[np.minimum(s + i, len(code) - 1)] == ord(x)
            taken[hit] = len(c)
        shift[lone + 1] = taken
    begin = begin + shift
    long, single = b - a >= 2, b - a == 1
    own = np.where(space, closes | long | (single & ~blank), begin < b)
    starts = [begin[own]]
    extra = space & ~closes & long & ~blank
    starts.append(b[extra] - 1)
    at = np.sort(np.concatenate(starts))
    first_byte = byte_at[at]
    text = np.searchsorted(np.cumsum(size), first_byte, "right")
    return buf, first_byte, text


def byte_hashes(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of each part of ``buf``; the parts tile it."""
    size = np.diff(np.append(start, len(buf)))
    at = np.arange(len(buf)) - np.repeat(start, size)
    v = (buf.astype(U) + U(1)) * powers(int(size.max()))[at]
    return mix(np.add.reduceat(v, start) + size.astype(U) * U(0x94D049BB133111EB))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: hash, displace, and for
    buckets of one key its slot itself (below zero)."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.buckets = max(1, n // 4)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.n = n
        free = np.ones(n, dtype=bool)
        home = (keys % U(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        at = np.searchsorted(home[order], np.arange(self.buckets + 1))
        self.slot_of = np.zeros(n, dtype=np.int64)
        lone = []
        for b in np.argsort(-np.diff(at), kind="stable"):
            own = order[at[b]:at[b + 1]]
            if len(own) == 1:
                lone.append((b, own[0]))
                continue
            d = 0
            while len(own):
                tries = np.arange(d, d + 64, dtype=U)
                slots = self._place(keys[own][None, :], tries[:, None])
                ok = free[slots].all(axis=1)
                ok &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if ok.any():
                    i = int(np.argmax(ok))
                    self.shift[b] = d + i
                    self.slot_of[own] = slots[i]
                    free[slots[i]] = False
                    break
                d += 64
        for (b, own), slot in zip(lone, np.flatnonzero(free)):
            self.shift[b] = -1 - slot
            self.slot_of[own] = slot

    def _place(self, keys, d):
        return (mix(keys + d * U(0x9E3779B97F4A7C15)) % U(self.n)).astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        d = self.shift[(keys % U(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._place(keys, np.maximum(d, 0).astype(U)))


class Vocabulary:
    """Ranks of byte strings, their perfect hash, character classes, and the cache of merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        entries = list(ranks)
        start = np.cumsum([0, *map(len, entries)])[:-1]
        keys = byte_hashes(np.frombuffer(b"".join(entries), dtype=np.uint8), start)
        self.hash = PerfectHash(keys)
        self.entry = [b""] * len(entries)
        self.id = np.zeros(len(entries), dtype=np.uint32)
        for e, s in zip(entries, self.hash.slot_of.tolist()):
            self.entry[s] = e
            self.id[s] = ranks[e]
        self.key = np.zeros(len(entries), dtype=U)
        self.key[self.hash.slot_of] = keys
        # by id, for decoding
        by_id = sorted(entries, key=ranks.__getitem__)
        top = max(ranks.values()) + 1
        self.size = np.zeros(top, dtype=np.int64)
        self.place = np.zeros(top, dtype=np.int64)
        ids = np.array([ranks[e] for e in by_id])
        self.size[ids] = [len(e) for e in by_id]
        self.place[ids] = np.cumsum([0, *map(len, by_id)])[:-1]
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)
        self.single = [ranks[bytes((x,))] for x in range(256)]
        #: rank of the entry that two entries make together
        self.pairs = {ranks[a] << 20 | ranks[b]: ranks[e] for e in entries for i in range(1, len(e))
                      if (a := e[:i]) in ranks and (b := e[i:]) in ranks}
        self.kinds = classes()
        self.cache: dict[bytes, bytes] = {}

    def merge(self, part: bytes) -> bytes:
        """Packed ids of a pre-token that is no entry: least rank first, leftmost first.

        The heap holds rank * 2**32 + place; a part that was joined to its left
        neighbour has the id -1.
        """
        if (known := self.cache.get(part)) is not None:
            return known
        pair, n = self.pairs.get, len(part)
        ids = [self.single[x] for x in part]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := pair(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            r, i = x >> 32, x & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j == n or pair(ids[i] << 20 | ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (x := pair(r << 20 | ids[j])) is not None:
                    heapq.heappush(heap, x << 32 | i)
            if (j := before[i]) >= 0 and (x := pair(ids[j] << 20 | r)) is not None:
                heapq.heappush(heap, x << 32 | j)
        out = array("I", [x for x in ids if x >= 0]).tobytes()
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[part] = out
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as unsigned 32-bit numbers, number of each text's)."""
        buf, start, text = pre_tokens(texts, self.kinds)
        if not len(start):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        hashes = byte_hashes(buf, start)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        joined = buf.tobytes()
        end = np.append(start[1:], len(buf))
        parts = [joined[a:b] for a, b in zip(start[where].tolist(), end[where].tolist())]
        slot = self.hash.slot(keys)
        hit = self.key[slot] == keys
        pool = self.id[slot]
        entry = self.entry
        missed = []
        for i, (part, s, h) in enumerate(zip(parts, slot.tolist(), hit.tolist())):
            if not h or entry[s] != part:
                missed.append(i)
        count = np.ones(len(keys), dtype=np.int64)
        place = np.arange(len(keys))
        more = [self.merge(parts[i]) for i in missed]
        size = np.fromiter(map(len, more), dtype=np.int64, count=len(more)) // 4
        place[missed] = len(keys) + np.cumsum(size) - size
        count[missed] = size
        pool = np.concatenate((pool, np.frombuffer(b"".join(more), dtype=np.uint32)))
        n = count[back]
        at = np.arange(int(n.sum())) + np.repeat(place[back] - (np.cumsum(n) - n), n)
        return pool[at], np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all ids, number of each id's bytes)."""
        n = self.size[ids]
        at = np.arange(int(n.sum())) + np.repeat(self.place[ids] - (np.cumsum(n) - n), n)
        return self.bytes[at].tobytes(), n


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def broadcast_vocabulary(spark: SparkSession, path: str):
    """The vocabulary with its hash, built once on the driver; its size is that of the rank file."""
    ship(spark)
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path)))


def _encoded(shared, column: str):
    @released
    def run(batches):
        v = shared.value
        for batch in batches:
            c = batch.schema.get_field_index(column)
            rest = [i for i in range(batch.num_columns) if i != c]
            for lo, hi, texts in text_slices(batch, c):
                ids, n = v.encode(texts)
                packed, end = ids.astype("<u4").tobytes(), np.cumsum(n) * 4
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in rest), pa.array(n),
                     pa.array([packed[b - 4 * k:b] for b, k in zip(end.tolist(), n.tolist())], pa.binary())],
                    names=[*(batch.schema.names[i] for i in rest), "n_tokens", "ids"])
        v.cache.clear()
    return run


def _decoded(shared):
    @released
    def run(batches):
        v = shared.value
        for batch in batches:
            c = batch.schema.get_field_index("ids")
            for lo, hi, packed in text_slices(batch, c):
                n = [len(x) // 4 for x in packed]
                out, size = v.decode(np.frombuffer(b"".join(packed), dtype="<u4"))
                at = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n)))].tolist()
                yield pa.RecordBatch.from_arrays(
                    [*(x.slice(lo, hi - lo) for x in batch.columns),
                     pa.array([out[a:b] for a, b in zip(at, at[1:])], pa.binary())],
                    names=[*batch.schema.names, "decoded"])
    return run


def _schema(df: DataFrame, drop: str | None) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != drop)


def encode(df: DataFrame, vocabulary, column: str = "text") -> DataFrame:
    """``df`` with n_tokens and ids (little-endian unsigned 32-bit numbers) in place of the text."""
    kinds = ", ".join(x for x in (_schema(df, column), "n_tokens long, ids binary") if x)
    return df.mapInArrow(_encoded(vocabulary, column), kinds)


def decode(df: DataFrame, vocabulary) -> DataFrame:
    """``df`` (with ids) and the decoded bytes."""
    return df.mapInArrow(_decoded(vocabulary), f"{_schema(df, None)}, decoded binary")


def tokens_and_text(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every text and their digests, with the digest of the decoded bytes."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = broadcast_vocabulary(spark, path)
    both = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_and_text(spark, table(spark, sf_dir, "documents"))
