import random

import duckdb

from strata.llm import chat_format as cf


def same(spark, base):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{base}/conversations.parquet/*.parquet')")
    want = sorted(map(str, con.execute(cf.ORACLE).fetchall()))
    got = sorted(str(tuple(r)) for r in cf.op10_reply_tree_chat_format(spark, base).collect())
    assert got == want
    return got


SCHEMA = "conv_id long, turn long, role string, text string, tree string, node int, formatted string"


def test_query_equals_sql(spark, write_table):
    rng = random.Random(1)
    words = ["[INST]", "</s>", "\\", "<\\/s>", "[\\\\/INST]", "ok", "\n", "é", "<", "[", "[/INST]", "INST]", "/s>"]
    rows = [(i // 3, rng.randint(0, 5), rng.choice(["user", "assistant", "system", None, "[INST]"]),
             "".join(rng.choice(words) for _ in range(rng.randint(0, 9))), "t", 1, "f") for i in range(200)]
    rows += [(900, 0, "user", None, None, None, None), (None, 0, "assistant", "x", "t", 1, "f"),
             (None, None, None, "[INST]", "t", 1, "f"), (902, 0, "user", "y" * 100_000, "t", 1, "f")]
    rows += [(901, i, "assistant" if i % 2 else "user", f"t{i}</s>", "t", 1, "f") for i in range(70)]
    rows += [rows[0], rows[0]]
    same(spark, write_table(conversations=spark.createDataFrame(rows, SCHEMA)))


def test_no_conversations(spark, write_table):
    got = same(spark, write_table(conversations=spark.createDataFrame([], SCHEMA)))
    assert len(got) == 1 and got[0].startswith("(-1, 2,")


def test_paths_of_a_tree_are_ranked_and_formatted(spark):
    rng = random.Random(2)
    nodes, parent = [], {}
    for tree in range(6):
        for n in range(1, rng.randint(2, 40)):
            p = rng.randrange(n) or None if n > 1 else None
            parent[tree, n] = p
            nodes.append((tree, n, p, rng.choice(["user", "assistant"]), f"{tree}.{n}", float(rng.randint(0, 4))))
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    by = {(t, n): (r, x, s) for t, n, _, r, x, s in nodes}
    inner = {(t, p) for (t, _), p in parent.items()}
    want = {}
    for t, n in parent:
        if (t, n) not in inner:
            way, at = [], n
            while at:
                way.append(at)
                at = parent[t, at]
            want[t, n] = way[::-1]
    way = cf.paths(spark, df)
    got = {}
    for r in way.collect():
        got.setdefault((r["tree"], r["leaf"]), []).append((-r["above"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    ranked = cf.rank_paths(way, df).collect()
    score = {(t, leaf): sum(by[t, n][2] for n in w) for (t, leaf), w in want.items()}
    for t in range(6):
        own = sorted((k for k in want if k[0] == t), key=lambda k: (-score[k], k[1]))
        assert [(r["tree"], r["leaf"]) for r in sorted((r for r in ranked if r["tree"] == t), key=lambda r: r["rank"])] == own
    best = cf.best_paths(way, df)
    assert {(r["tree"], r["leaf"]) for r in best.collect()} == {(r["tree"], r["leaf"]) for r in ranked if r["rank"] == 1}
    for r in cf.format_paths(way, cf.rank_paths(way, df), df).collect():
        turns = [by[r["tree"], n] for n in want[r["tree"], r["leaf"]]]
        assert r["formatted"] == "".join(f"[INST]{a}[/INST]{b}</s>" for a, b, _ in turns)
        assert [r["formatted"][s["first"]:s["first"] + s["length"]] for s in r["loss"]] == [
            b for a, b, _ in turns if a == "assistant"]


def test_branches_are_chosen_formatted_and_read_back(spark):
    """The query's own way, on trees whose scores decide between branches."""
    from pyspark.sql import functions as F

    rows = [(1, 1, None, "user", "ask [INST]", 0.0), (1, 2, 1, "assistant", "poor", 1.0), (1, 3, 1, "assistant", "good </s>", 2.0),
            (1, 4, 3, "user", "thanks", 0.5), (1, 5, 2, "user", "why", 0.5), (1, 6, 5, "assistant", "because", 0.75),
            (2, 1, None, "user", "a", None), (2, 2, 1, "assistant", "tie", 1.0), (2, 3, 1, "assistant", "tie too", 1.0),
            (None, 1, None, "assistant", "alone", 0.0)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    way = cf.paths(spark, nodes)
    chats = cf.format_paths(way, cf.best_paths(way, nodes), nodes)
    back = chats.select("tree", "leaf", cf.read_turns(F.col("formatted")).alias("turns"),
                        cf.read_loss(F.col("formatted"), F.col("loss")).alias("spoken")).collect()
    got = {r["tree"]: (r["leaf"], [tuple(t) for t in r["turns"]], r["spoken"]) for r in back}
    assert got == {
        1: (4, [("user", "ask [INST]"), ("assistant", "good </s>"), ("user", "thanks")], "good </s>"),
        2: (2, [("user", "a"), ("assistant", "tie")], "tie"), None: (1, [("assistant", "alone")], "alone")}


def test_no_python_on_the_main_path(spark, write_table):
    rows = [(1, i, "user", "x", "t", 1, "f") for i in range(3)]
    base = write_table(conversations=spark.createDataFrame(rows, SCHEMA))
    plan = cf.op10_reply_tree_chat_format(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
