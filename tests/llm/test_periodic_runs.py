import hashlib
import random
import re
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import periodic_runs as pr


def runs_of(texts, short):
    sizes = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    x = np.concatenate([np.append(np.array(t, dtype=np.int64), 1000 + i) for i, t in enumerate(texts)])
    base = np.cumsum(sizes + 1) - sizes - 1
    out = [[] for _ in texts]
    for a, b, q in zip(*(v.tolist() for v in pr.find_runs(x, text, sizes, short))):
        out[text[a]].append((a - int(base[text[a]]), b - a, q))
    return [sorted(x) for x in out]


def structured(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(200))]
    if kind == 1:  # neighbouring runs of one short period, shifted against each other
        d = rng.choice([1, 2, 3])
        root = [rng.randrange(3) for _ in range(d)]
        out = []
        for _ in range(rng.randrange(2, 5)):
            r = rng.randrange(d)
            out += ((root[r:] + root[:r]) * 60)[:rng.randrange(1, 80)]
        return out * rng.choice([1, 1, 2])
    if kind == 2:  # a long period
        p = [rng.randrange(4) for _ in range(rng.randrange(1, 70))]
        return ([5] * rng.randrange(9) + p * 4)[:rng.randrange(250)] + [6] * rng.randrange(9)
    if kind == 3:  # short runs inside a long period
        p = [0] * rng.randrange(40) + [1] + [0, 1] * rng.randrange(10) + [2] * rng.randrange(12)
        return (p * 3)[:rng.randrange(300)]
    if kind == 4:  # no cube: each word doubles
        t = [0]
        while len(t) < 256:
            t += [1 - x for x in t]
        return t[rng.randrange(40):][:rng.randrange(256)]
    f = [[0], [0, 1]]
    while len(f[-1]) < 250:
        f.append(f[-1] + f[-2])
    return f[-1][rng.randrange(30):][:rng.randrange(250)]


def test_runs_equal_brute_force_at_every_scale():
    rng = random.Random(7)
    for i in range(500):
        texts = [structured(rng) for _ in range(rng.randrange(1, 5))]
        want = [pr.brute_force(t, 0) for t in texts]
        for short in (4, 8, 32):
            assert runs_of(texts, short) == want, (i, short)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 4), st.sampled_from([4, 8]))
def test_runs_of_repeated_lists(base, times, short):
    assert runs_of([base * times], short) == [pr.brute_force(base * times, 0)]


def test_long_periods_of_a_long_text():
    rng = random.Random(2)
    p = [rng.randrange(500) for _ in range(700)]
    t = [rng.randrange(500) for _ in range(300)] + p * 3 + p[:123] + [rng.randrange(500) for _ in range(50)]
    assert (300, 3 * 700 + 123, 700) in runs_of([t], 32)[0]
    assert runs_of([[1] * 20_000], 32) == [[(0, 20_000, 1)]]
    two = [1, 2] * 3000 + [2, 1] * 3000  # neighbours of one period make a run at every odd lag
    assert len(runs_of([two], 32)[0]) == len(pr.brute_force(two[5500:6500], 0)) + (2999 - 249)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = pr.brute_force(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(left))


def test_query_equals_brute_force(spark, write_table):
    rng = random.Random(5)
    words = ["the", "of", "Ünï", "a", "x y", "end."]
    docs = []
    for i in range(150):
        t = [rng.choice(words) + (str(rng.randrange(50)) if rng.random() < 0.7 else "") for _ in range(rng.randrange(260))]
        if rng.random() < 0.3:
            t += t[len(t) // 2:] * 2
        docs.append((i, rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t\n", "\x0b"]).join(t)))
    docs += [(500, None), (501, ""), (502, " \n "), (3, docs[3][1]), (None, docs[4][1]), (503, "a " * 9000)]
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = [tuple(r) for r in pr.op13_periodic_runs(spark, base).collect()]
    want = [expected(d, t) for d, t in docs if d != 503]
    key = lambda r: tuple((x is None, x or 0) for x in r[:6])
    assert sorted((r for r in got if r[0] != 503), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in got) > 30
    assert [r[1:6] for r in got if r[0] == 503] == [(1, 0, 9000, 1, 9_000_000)]


def test_edges_and_clashing_columns(spark, edge_docs, no_docs):
    out = pr.periodic_runs(spark, edge_docs).collect()
    assert len(out) == edge_docs.count()
    by = {r["doc_id"]: r for r in out}
    assert by[6]["n_runs"] == 1 and by[6]["period"] == 14 and by[6]["length"] == 14 * 4000
    assert by[6]["collapsed"] == "The quick brown fox jumps over the lazy dog near the river bank today."
    assert by[3]["n_words"] == 0 and by[3]["start"] is None and by[4]["collapsed"] == "" and by[8]["n_runs"] == 0
    assert pr.periodic_runs(spark, no_docs).count() == 0
    empty = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [r["n_runs"] for r in pr.periodic_runs(spark, empty).collect()] == [0]
