import math
import random
import re

import duckdb
import numpy as np

from strata.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, top=10):
    counted = [(d, words(t)) for d, t in docs]
    counted = [(d, w) for d, w in counted if w]
    n, total = len(counted), sum(len(w) for _, w in counted)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    out = []
    for i, own in terms.items():
        weight = {}
        for t in own:
            df = sum(t in w for _, w in counted)
            weight[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        scored = []
        for d, w in counted:
            m = 100 - 90 + 90 * len(w) * n // total
            s = sum(weight[t] * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in own)
            if s > 0:
                scored.append((s, d))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(i, k + 1, d, s) for k, (s, d) in enumerate(scored[:top])]
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(rng, n=200):
    some = ["the", "THE", "of", "cat", "concatenate", "über", "Über", "x1", "é", "end", "a-b", "it's", "don`t", "[z]"]
    docs = [(i, " ".join(rng.choice(some) + (str(rng.randrange(30)) if rng.random() < 0.4 else "")
                         for _ in range(rng.randrange(60)))) for i in range(n)]
    docs += [(500, None), (501, ""), (502, "... --"), (3, docs[3][1]), (None, docs[4][1]), (-7, docs[4][1]),
             (503, "the cat " * 20_000), (504, docs[4][1]), (505, docs[4][1])]
    items = [(i, " ".join(rng.choice(docs)[1].split()[:12]) if docs[i][1] else "") for i in range(8)]
    items += [(20, "the the THE"), (21, None), (22, "..."), (23, "absent words"), (20, "cat"), (None, "über"), (24, "The Cat\n"),
              (24, "The Cat\n")]
    return docs, items


def test_query_equals_brute_force_and_oracle(spark, write_table):
    docs, items = corpus(random.Random(4))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                       benchmark=spark.createDataFrame(items, "item_id long, text string"))
    want = ordered(brute_force(docs, items))
    got = ls.op11_automaton_lexical_search(spark, base)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(got.collect()) == want
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet/*.parquet')")
    assert ordered(con.execute(ls.ORACLE).fetchall()) == want
    assert {r[0] for r in want} >= {20, 24, None}


def test_blocks_and_small_heaps_change_nothing(spark, monkeypatch):
    docs, items = corpus(random.Random(9), 120)
    frames = (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
              spark.createDataFrame(items, "item_id long, text string"))
    want = ordered(brute_force(docs, items, 4))
    monkeypatch.setattr(ls, "QUERY_BYTES", 150)
    assert len(list(ls.item_blocks(frames[1]))) > 2
    assert ordered(ls.search(spark, *frames, top=4).collect()) == want


def test_best_keeps_the_first_of_equal_scores():
    rng = np.random.default_rng(3)
    for _ in range(50):
        scores = rng.integers(0, 4, (60, 3))
        doc, null = rng.permutation(60), (rng.random(60) < 0.1).astype(np.int64)
        best = ls.Best(3, 5)
        for a in range(0, 60, 7):
            best.add(scores[a:a + 7], doc[a:a + 7], null[a:a + 7])
            if rng.random() < 0.5:
                best.cut()
        got = list(zip(*(x.tolist() for x in best.cut())))
        want = []
        for i in range(3):
            rows = sorted((-int(scores[r, i]), int(null[r]), int(doc[r])) for r in range(60) if scores[r, i] > 0)
            want += [(i, -s, d, n) for s, n, d in rows[:5]]
        assert got == want


def test_edges_and_clashing_columns(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "dog cat", 1.0)], "item_id long, text string, score double")
    got = ls.search(spark, edge_docs.withColumn("rank", edge_docs["n_chars"]), items).collect()
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert ordered(got) == ordered(brute_force(rows, [(1, "dog cat")]))
    assert ls.search(spark, no_docs, items).count() == 0
    assert ls.search(spark, edge_docs, items.limit(0)).count() == 0
