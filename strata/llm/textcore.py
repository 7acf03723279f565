"""Array views of batches of UTF-8 texts: words, their hashes, n-grams.

A batch is one byte buffer in which a space separates the texts, so words
never cross texts. Word hashes are 64-bit polynomials of the bytes, finalised
by a multiply-xorshift mix; equal words always have equal hashes.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_C1, _C2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a lower-cased text.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of words [^\x20\x09-\x0D]+.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[9:14] = VISIBLE[32] = False

_powers = np.ones(1, dtype=U)


def powers(n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n."""
    global _powers
    if len(_powers) < n:
        a = np.full(max(n, 1024), _BASE, dtype=U)
        a[0] = 1
        _powers = np.multiply.accumulate(a)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * _C1
    h = (h ^ (h >> U(27))) * _C2
    return h ^ (h >> U(31))


class Words:
    """Words of a batch: byte range in ``buf``, text number and hash of each."""

    def __init__(self, texts: list[bytes], lower: bool, inside: np.ndarray):
        joined = b" ".join(texts) + b" "
        buf = np.frombuffer(joined, dtype=np.uint8)
        self.buf = LOWER[buf] if lower else buf
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.first_byte = np.cumsum(sizes + 1) - sizes - 1
        m = inside[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], m, [False])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.text = np.searchsorted(self.first_byte, self.start, "right") - 1
        #: words of text i are count_before[i] .. count_before[i + 1]
        self.count_before = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self._mask = m
        self._hash = None

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.count_before)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            size = self.end - self.start
            if not len(size):
                self._hash = np.zeros(0, dtype=U)
                return self._hash
            before = np.cumsum(size) - size
            at = np.arange(int(size.sum())) - np.repeat(before, size)
            v = (self.buf[self._mask].astype(U) + U(1)) * powers(int(size.max()))[at]
            self._hash = mix(np.add.reduceat(v, before) + size.astype(U) * _C2)
        return self._hash

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of k words; a text of 1 to k-1 words has one."""
    h, n, lo = words.hash, words.n, words.count_before[:-1]
    if not len(h):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    pw = powers(k + 1)
    run = np.zeros(len(h), dtype=U)
    for j in range(min(k, len(h))):
        part = h[j:] * (pw[j] | U(1)) if j else h
        run[:len(h) - j] += part[:len(h) - j]
    # a short text: its words up to the text's end only
    short = np.flatnonzero((n > 0) & (n < k))
    for t in short:
        w = h[lo[t]:lo[t] + n[t]]
        run[lo[t]] = (w * np.where(np.arange(len(w)) > 0, pw[:len(w)] | U(1), U(1))).sum(dtype=U) + U(n[t])
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    before = np.cumsum(count) - count
    at = np.arange(int(count.sum())) - np.repeat(before, count) + np.repeat(lo, count)
    return text, mix(run[at])
