import itertools
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import bag_minhash as bm
from strata.llm.textcore import mix


def jaccard(a, b):
    return sum(min(a[k], b[k]) for k in a.keys() & b.keys()) / sum(max(a[k], b[k]) for k in a.keys() | b.keys())


def multiset(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_registers_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(0)
    a = Counter({i: int(rng.integers(1, 6)) for i in range(120)})
    b = Counter(a)
    for i in range(25):
        b[i] = int(rng.integers(1, 30))
    found = []
    for s in range(30):
        rows = [(t, k, v) for t, c in enumerate((a, b)) for k, v in c.items()]
        h = mix(np.array([r[1] for r in rows], dtype=np.uint64) + np.uint64(s * 100003))
        sig = bm.signatures(np.array([r[0] for r in rows]), h, np.array([r[2] for r in rows]), 2, 256)
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - jaccard(a, b)) < 0.02


def corpus(rng, n=200):
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(30)]
    docs = []
    for i in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            t[rng.randrange(len(t))] = rng.choice(words)
        docs.append((i, " ".join(t)))
    return docs + [(400, None), (401, ""), (402, ""), (403, "!!!"), (5, docs[5][1]), (5, docs[9][1]), (None, docs[7][1])]


def classes(docs):
    sets = [multiset(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
            parent[find(i)] = find(j)
    out = {}
    for i, d in enumerate(docs):
        out.setdefault(find(i), []).append(d)
    return sorted(sorted(map(str, c)) for c in out.values())


def test_groups_equal_brute_force_also_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(bm, "BLOCK", 3)
    docs = corpus(random.Random(5))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    group = bm.near_duplicates(spark, df)
    rows = df.select("doc_id", "text", bm.text_digest(F.col("text")).alias("item")).join(group, "item", "left").collect()
    got = {}
    for k, r in enumerate(rows):
        got.setdefault((r["one"]["first"], bytes(r["one"]["item"])) if r["one"] else k, []).append((r["doc_id"], r["text"]))
    assert sorted(sorted(map(str, c)) for c in got.values()) == classes(docs)
    kept = bm.near_dedup(spark, df)
    assert kept.count() == len(classes(docs)) and kept.columns == df.columns


def test_query_has_a_row_per_document(spark, write_table, edge_docs, no_docs):
    out = bm.op7_bag_minhash_dedup(spark, write_table(documents=edge_docs)).collect()
    assert len(out) == edge_docs.count()
    assert {r["class_id"] for r in out if r["doc_id"] in (1, 2)} == {1}
    assert {r["class_size"] for r in out if r["doc_id"] in (6, 7)} == {2}
    assert {(r["class_id"], r["class_size"]) for r in out if r["doc_id"] == 3} == {(3, 1)}
    assert bm.near_dedup(spark, edge_docs).count() == 7
    assert bm.near_dedup(spark, no_docs).count() == 0
