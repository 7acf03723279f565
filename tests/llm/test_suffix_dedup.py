import random

import numpy as np

from strata.llm import suffix_dedup as sd
from strata.llm.gsaca import suffix_array
from strata.llm.queries import QUERIES


def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 14))]
        assert suffix_array(np.array(a, dtype=np.int64)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


def corpus(rng):
    words = ["ab", "cde", "the", "of", "xyz", "q", "Ünï", "\n", "a"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    base = [prose(rng.randint(1, 400)) for _ in range(20)]
    docs = []
    for i in range(100):
        r, t = rng.random(), rng.choice(base)
        if 0.2 < r < 0.5:
            t = list(t)
            for _ in range(rng.randint(1, 4)):
                t[rng.randrange(len(t))] = "#"
            t = "".join(t)
        elif r < 0.7:
            a = rng.randrange(len(t) + 1)
            t = prose(20) + t[a:a + rng.randint(300, 600)] + rng.choice(base)[:rng.randint(300, 500)] + prose(10)
        elif r < 0.8:
            t = "a" * rng.randint(0, 1500)
        elif r < 0.85:
            t = ("ab" * 700)[:rng.randint(500, 1400)] + prose(3)
        elif r >= 0.85:
            t = prose(rng.randint(0, 300))
        docs.append((i, t))
    return docs + [(500, None), (501, ""), (3, docs[3][1]), (3, prose(200)), (None, base[0])]


def expected(docs, length=400):
    found = sd.brute_force([(t or "").encode() for _, t in docs], length)
    return sorted((-1 if d is None else d, len((t or "").encode()), *e) for (d, t), e in zip(docs, found))


def test_query_equals_brute_force(spark, write_table):
    docs = corpus(random.Random(3))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in sd.op1_suffix_array_dedup(spark, base).collect())
    assert got == expected(docs)
    assert sum(r[2] > 0 for r in got) > 30


def test_edges_and_clashing_columns(spark, edge_docs, no_docs):
    out = sd.suffix_dedup(spark, edge_docs).collect()
    assert len(out) == edge_docs.count()
    by = {(r["doc_id"], r["source"]): r for r in out}
    assert by[(6, "s")]["n_removed"] == by[(6, "s")]["n_chars"] and bytes(by[(6, "s")]["kept"]) == b""
    assert by[(8, "s")]["n_removed"] == 3000 and by[(3, "s")]["n_removed"] == 0
    assert by[(1, "s")]["digest"] == "y"
    assert sd.suffix_dedup(spark, no_docs).count() == 0


def test_passages_of_over_fifty_words_go_by_their_bytes(spark, write_table):
    rng = random.Random(17)

    def prose(size):
        t = ""
        while len(t) < size:
            t += "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) + " "
        return t[:size - 1] + "z"
    docs, sizes = [], [330, 390, 398, 399, 400, 401, 410, 500]
    for size in sizes:
        passage = prose(size)
        assert len(passage.split()) > 50
        # other bytes at both edges, so that no more than the passage is equal
        docs += [prose(150) + "1" + passage + "2" + prose(90), "3" + passage + "4" + prose(300)]
    docs = list(enumerate(docs))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(tuple(r) for r in sd.op1_suffix_array_dedup(spark, base).collect())
    assert got == expected(docs)
    assert [r[2] for r in got] == [n if n >= 400 else 0 for n in sizes for _ in range(2)]


def test_periodic_starts_equal_brute_force(spark, write_table):
    letters = [chr(33 + i) for i in range(50)]
    texts = [c * n for c, n in zip(letters, range(401, 451))]
    rng = random.Random(5)
    for period in (2, 7, 13, 20, 31, 45):
        for size in (400 + period, 413, 425 + period, 444 + period):
            phrase = "".join(rng.choice("klmnop") for _ in range(period - 1)) + " "
            tail = "".join(rng.choice("rstuvw ") for _ in range(rng.randint(0, 300)))
            texts += [(phrase * 400)[:size] + tail, tail[:90] + (phrase * 400)[:size]]
    docs = list(enumerate(texts))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(tuple(r) for r in sd.op1_suffix_array_dedup(spark, base).collect())
    assert got == expected(docs)
    assert got[19][2] == 420


def test_hot_cores_are_split(spark, write_table, monkeypatch):
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, phrase = noise(900), noise(30)
    docs = [(i, noise(rng.randint(0, 60)) + passage + noise(rng.randint(0, 60))) for i in range(80)]
    docs += [(100 + i, docs[i][1][:rng.randint(300, 700)] + noise(50)) for i in range(40)]
    docs += [(200 + i, noise(i) + (phrase * 40)[:rng.randint(400, 600)] + noise(20)) for i in range(20)]
    docs += [(300 + i, d[1]) for i, d in enumerate(docs[:5])]
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    names, write = [], sd.stored
    monkeypatch.setattr(sd, "stored", lambda spark, df, name: (names.append(name), write(spark, df, name))[1])
    whole = sorted(tuple(r) for r in sd.op1_suffix_array_dedup(spark, base).collect())
    assert whole == expected(docs) and "dedup-parts" not in names
    for most, rounds in ((1, 2), (5, 2)):
        names.clear()
        monkeypatch.setattr(sd, "MOST_SEGMENTS", most)
        got = sorted(tuple(r) for r in sd.op1_suffix_array_dedup(spark, base).collect())
        assert got == whole and names.count("dedup-parts") == rounds


def with_passages(docs):
    """The contract's columns of each row and the words in stretches of 51 words that start elsewhere too."""
    texts = [(t or "").encode() for _, t in docs]
    rows = zip(docs, texts, sd.brute_force(texts, 400), sd.brute_passages(texts, 51))
    return sorted((-1 if d is None else d, len(b), *e, n) for (d, _), b, e, n in rows)


def passage_docs(rng):
    def words(n, most=9):
        return [rng.choice("abcdefgh") + "".join(rng.choice("klmnop\u00e9") for _ in range(rng.randint(0, most))) for _ in range(n)]

    def text(*parts):
        return rng.choice(["", " ", "\n "]) + " ".join(" ".join(p) for p in parts)
    docs, short = [], []
    for n in (49, 50, 51, 52, 58, 70, 90):
        for most in (1, 3, 9):
            passage = words(n, most)
            short += [len(docs)] if n > 50 and len(" ".join(passage).encode()) < 390 else []
            docs += [text(words(rng.randint(0, 40)), passage, words(rng.randint(0, 40))) for _ in range(2)]
    shared = words(300, 2)
    docs += [text(words(rng.randint(0, 9)), shared[a:a + n], words(rng.randint(0, 70)), shared[a + 5:a + 5 + rng.randint(40, 60)])
             for a, n in ((rng.randrange(240), rng.randint(45, 130)) for _ in range(40))]
    docs += ["a b " * 40, "c " * 51, "c " * 52, "x " * 600, " ".join(words(60, 1)), " ".join(words(80, 9))]
    docs += [docs[-2], docs[-1], docs[-2], "q " * 50, "q " * 50, None, ""]
    return [*enumerate(docs), (3, docs[3]), (None, docs[0])], short


def test_short_passages_of_over_fifty_words_are_counted(spark, write_table, monkeypatch):
    docs, short = passage_docs(random.Random(23))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    want = with_passages(docs)
    query = QUERIES["op1_suffix_array_dedup"]
    out = query(spark, base)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in out.collect()) == want
    assert len(short) > 5
    # nothing of these passages is cut, as they have fewer than 400 bytes, but all their words are counted
    by = {w[0]: w for w in want}
    assert all(by[i][5] > 50 for i in short) and any(by[i][2] == 0 for i in short)
    monkeypatch.setattr(sd, "CUT_BYTES", 700)  # texts in parts
    assert sd.passage_words(b"a " * 2000, 51, (np.array([0]), np.array([4000])), [0, 3900 - 2]) == 2000
    texts = [(t or "").encode() for _, t in docs]
    for t in texts:
        parts = sd._word_parts(t, 51)
        each = [s for a, b in parts for s in stretch_texts(t[a:b])]
        assert each == stretch_texts(t)


def stretch_texts(t):
    words, begin, _, _ = sd.stretches([t], 51)
    return [t[words.start[i]:words.end[i + 50]] for i in begin]


def test_passages_equal_brute_force_on_mixed_texts(spark, write_table):
    docs = corpus(random.Random(3))
    base = write_table(documents=spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in QUERIES["op1_suffix_array_dedup"](spark, base).collect())
    assert got == with_passages(docs)
    assert 30 < sum(r[5] > 0 for r in got) < len(got)
