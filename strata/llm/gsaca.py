"""Suffix array by linear grouping: Lyndon-prefix groups, previous-smaller links.

Phase 1 handles the groups of suffixes in descending order. For each suffix of
the group it finds the nearest suffix to its left that lies in a lower group
(its previous smaller one); those pointed at move to new groups just above
their old group, the more often pointed at the higher. At the end a group
holds the suffixes with the same longest Lyndon prefix. Phase 2 walks the
array upwards from the end of the text and puts each suffix, and then its
chain of previous smaller ones, at the next place of its group. Names are
never reduced and there is no recursion.
"""

from __future__ import annotations

import numpy as np

UNKNOWN = -2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of non-negative integers (no end symbol in it)."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(text, kind="stable")
    ranked = np.asarray(text)[order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    starts = np.flatnonzero(head)
    group_at = starts[np.cumsum(head) - 1]
    link = np.empty(n, dtype=np.int64)
    link[order] = group_at
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    size_at = np.zeros(n, dtype=np.int64)
    size_at[starts] = np.diff(np.append(starts, n))
    sa, link, place, size = order.tolist(), link.tolist(), place.tolist(), size_at.tolist()
    left = [UNKNOWN] * n

    top = n - 1
    while top >= 0:
        g = link[sa[top]]
        if g == top:
            i = sa[top]
            j = i - 1
            while j >= 0 and link[j] > g:
                j = left[j]
            left[i] = j
            if j >= 0 and size[link[j]] > 1:
                _raise([j], sa, link, place, size)
        else:
            times: dict[int, int] = {}
            for first in sa[g:top + 1]:
                waiting = [first]
                while waiting:
                    i = waiting[-1]
                    if left[i] != UNKNOWN:
                        waiting.pop()
                        continue
                    j = i - 1
                    while j >= 0 and link[j] > g:
                        j = left[j]
                    if j >= 0 and link[j] == g:  # a run of equal Lyndon words: that of its left member comes first
                        if left[j] == UNKNOWN:
                            waiting.append(j)
                            continue
                        j = left[j]
                    left[i] = j
                    waiting.pop()
                    if j >= 0:
                        times[j] = times.get(j, 0) + 1
            if times:
                if len(times) == 1:
                    _raise(list(times), sa, link, place, size)
                else:
                    by_count: dict[int, list[int]] = {}
                    for j, c in times.items():
                        by_count.setdefault(c, []).append(j)
                    for c in sorted(by_count, reverse=True):
                        _raise(by_count[c], sa, link, place, size)
        top = g - 1

    nxt = list(range(n))
    done = bytearray(n)
    out = [0] * n
    i = n
    at = -1
    while True:
        j = i - 1
        while j >= 0 and not done[j]:
            g = link[j]
            out[nxt[g]] = j
            nxt[g] += 1
            done[j] = 1
            j = left[j]
        at += 1
        if at == n:
            return np.array(out, dtype=np.int64)
        i = out[at]


def _raise(js: list[int], sa: list[int], link: list[int], place: list[int], size: list[int]) -> None:
    """Move suffixes to new groups, one for each old group, just above it."""
    moved: dict[int, list[int]] = {}
    for j in js:
        g = link[j]
        size[g] -= 1
        last = g + size[g]
        p, other = place[j], sa[last]
        sa[p], sa[last] = other, j
        place[other], place[j] = p, last
        moved.setdefault(g, []).append(j)
    for g, own in moved.items():
        start = g + size[g]
        size[start] = len(own)
        if start != g:
            for j in own:
                link[j] = start
