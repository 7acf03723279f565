import random

from strata.llm import decontaminate as dc


def least_edits(p, t):
    prev = [0] * (len(t) + 1)
    for i, a in enumerate(p):
        cur = [i + 1]
        for j, b in enumerate(t):
            cur.append(min(prev[j] + (a != b), prev[j + 1] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_search_equals_full_edit_distance():
    rng = random.Random(4)
    words = ["ab", "the", "of", "xy", "çé", "q1"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    for _ in range(120):
        items = [dc.Item(i, prose(rng.randint(1, 14)).encode()) for i in range(4)]
        given = []
        for _ in range(5):
            t = list(f"{prose(rng.randint(0, 15))} {rng.choice(items).text.decode()} {prose(rng.randint(0, 5))}")
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice("abx ")
            given.append("".join(t).encode())
        got = {(t, n): e for t, n, e, _, _ in dc.search(dc.automaton(items), items, given)}
        want = {}
        for i, t in enumerate(given):
            normal = dc.normal([t])[0]
            for j, x in enumerate(items):
                e = least_edits(x.text, normal) if normal else 99
                if e <= x.budget:
                    want[i, j] = e
        assert got == want


ITEM = "Which of the seven rivers named in the old song runs north past the mill and into the grey sea?"


def test_query_reports_spans_and_stage_drops_documents(spark, write_table, edge_docs, no_docs, monkeypatch):
    near = ITEM.upper().replace("SEVEN", "SEVENN").replace(" OLD", "")
    docs = spark.createDataFrame(
        [(1, "Before. " + ITEM + " After."), (2, f"x {near} y"), (3, "Which of the seven rivers named in it?"), (4, None),
         (5, ""), (1, "Before. " + ITEM + " After."), (None, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame(
        [(10, ITEM), (10, ITEM), (11, None), (12, ""), (13, "!?"), (14, "Another question about nothing in the table")],
        "item_id long, text string")
    out = dc.op8_pigeonhole_decontamination(spark, write_table(documents=docs, benchmark=bench)).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["edits"]) for r in out) == [
        ("1", 10, 0), ("1", 10, 0), ("2", 10, 5), ("None", 10, 0)]
    hit = next(r for r in out if r["doc_id"] == 1)
    assert ("Before. " + ITEM)[hit["first_byte"]:hit["end_byte"]] == ITEM[:-1]
    left = dc.without_leaks(spark, docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    monkeypatch.setattr(dc, "QUERY_BYTES", 40)  # several passes
    assert sorted(r["doc_id"] for r in dc.without_leaks(spark, docs, bench).collect()) == [3, 4, 5]
    kept = dc.without_leaks(spark, edge_docs, bench)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert dc.leaks(spark, no_docs, bench).count() == 0
    assert dc.leaks(spark, docs, bench.limit(0)).count() == 0


def full_edits(p, t):
    prev = list(range(len(t) + 1))
    for i, a in enumerate(p):
        cur = [i + 1]
        for j, b in enumerate(t):
            cur.append(min(prev[j] + (a != b), prev[j + 1] + 1, cur[-1] + 1))
        prev = cur
    return prev[-1]


def test_short_items_are_whole_words(spark):
    rng = random.Random(8)
    words = ["ab", "the", "of", "xy", "çé", "q1", "abthe", "ofxy"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    hits = 0
    for _ in range(150):
        items = [dc.Item(i, prose(rng.randint(1, 8)).encode()) for i in range(4)]
        items = [x for x in items if x.size <= dc.WHOLE_WORDS]
        given = []
        for _ in range(4):
            t = list(f"{prose(rng.randint(0, 8))} {rng.choice(items).text.decode() if items else ''} {prose(rng.randint(0, 5))}")
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice("abx ")
            given.append("".join(t).encode())
        got = {(t, n): (e, a, b) for t, n, e, a, b in dc.search(dc.automaton(items), items, given, dc.WHOLE_WORDS)}
        want = {}
        for i, t in enumerate(given):
            parts = dc.normal([t])[0].split()
            for j, x in enumerate(items):
                e = min((full_edits(x.text, b" ".join(parts[a:b])) for a in range(len(parts))
                         for b in range(a + 1, len(parts) + 1)), default=99)
                if e <= x.budget:
                    want[i, j] = e
        assert {k: v[0] for k, v in got.items()} == want
        for (i, j), (e, a, b) in got.items():
            assert full_edits(items[j].text, dc.normal([given[i][a:b]])[0][:-1]) == e
        hits += len(got)
    assert hits > 100
    docs = spark.createDataFrame([(1, "We concatenate it"), (2, "My cat, it sat"), (3, "cats"), (4, "A CAT")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in dc.leaks(spark, docs, bench).collect()) == [2, 4]
    assert sorted(r["doc_id"] for r in dc.without_leaks(spark, docs, bench).collect()) == [1, 3]
    # the rule is a parameter of both calls
    assert sorted(r["doc_id"] for r in dc.leaks(spark, docs, bench, whole_words=0).collect()) == [1, 2, 3, 4]
    assert dc.without_leaks(spark, docs, bench, whole_words=0).count() == 0
    long = "cat and dog and bird and fish live here"
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "con" + long + "in"), (2, long)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in dc.leaks(spark, docs, bench).collect()) == [1, 2]
    assert sorted((r["doc_id"], r["edits"]) for r in dc.leaks(spark, docs, bench, whole_words=1000).collect()) == [(2, 0)]
