import random
import re

import public_tokenizers
import tiktoken

import corpus_pipeline as cp
from strata.llm import byte_bpe, suffix_dedup
from test_bag_minhash import jaccard, multiset

ITEM = "Which of the seven rivers named in the old song runs north past the mill and into the grey sea?"


def corpus():
    rng = random.Random(7)
    words = {"en": ["the", "cat", "house", "with", "thing", "river", "other"],
             "fr": ["le", "chat", "maison", "avec", "chose", "fleuve", "autre"]}

    def prose(lang, n):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "er", str(rng.randint(0, 99))]) for _ in range(n))
    docs = []
    for i in range(60):
        lang = rng.choice(["en", "fr"])
        docs.append((i, prose(lang, rng.randint(20, 120)), lang))
    passage = prose("en", 90)
    for i in range(60, 70):
        docs.append((i, prose("en", 100) + " " + passage + " " + prose("en", 100), "en"))
    for i in range(70, 80):  # near copies
        t = docs[i - 70][1].split()
        t[-1] = "changed"
        docs.append((i, " ".join(t), docs[i - 70][2]))
    docs += [(90, prose("en", 40) + ". " + ITEM, "en"), (91, None, "en"), (92, "123 !!", "en"), (93, "", None)]
    return [(d, t, lang, "src", len(t or ""), f"extra{d}") for d, t, lang in docs]


def passages(texts, size=240, words=50):
    """The texts without passages of over fifty whole words, or 400 bytes, made of strings that start elsewhere too."""
    count = {}
    for t in texts:
        b = t.encode()
        for i in range(len(b) - size + 1):
            count[b[i:i + size]] = count.get(b[i:i + size], 0) + 1
    out = []
    for t in texts:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        for m in re.finditer(b"\1+", bytes(gone)):
            whole = [w for w in re.finditer(rb"[^\x20\x09-\x0D]+", b) if m.start() <= w.start() and w.end() <= m.end()]
            if len(whole) <= words and m.end() - m.start() < 400:
                gone[m.start():m.end()] = bytes(m.end() - m.start())
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


def brute(docs):
    """The rows that stages 1 to 4 leave, as (doc_id, text)."""
    left = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)]
    sets = {d: multiset(t) for d, t in left}
    kept, group = [], {}
    for d, t in sorted(left):
        same = {group[e] for e, _ in left if e in group and jaccard(sets[d], sets[e]) >= 0.8}
        for e in group:
            if group[e] in same:
                group[e] = min(same)
        group[d] = min(same) if same else d
    kept = [(d, t) for d, t in sorted(left) if group[d] == d]
    out = list(zip((d for d, _ in kept), passages([t for _, t in kept])))
    return [(d, t) for d, t in out if ITEM not in t]


def test_stages_and_run_equal_brute_force(spark, write_table):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    base = write_table(documents=frame, benchmark=bench)
    want = brute(docs)
    at = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        at = stage(spark, at, base)
        assert at.columns == frame.columns
    rows = at.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == want
    assert all(r["score"] == f"extra{r['doc_id']}" and r["n_chars"] == len(r["text"]) for r in rows)
    cut = {d for d, t in want if t != dict((x[0], x[1]) for x in docs)[d]}
    assert len(cut) == 10 and len(want) < 75
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")))
    out = {r["doc_id"]: r["n_tokens"] for r in cp.run(spark, base).collect()}
    assert out == {d: len(library.encode_ordinary(t)) for d, t in want}


def test_passages_of_over_fifty_words_go_and_shorter_ones_stay(spark):
    rng = random.Random(12)

    def prose(n, size=5):
        return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 2 * size - 2))) for _ in range(n))
    docs = []
    for n in (45, 50, 51, 56, 60, 70, 90):
        for size in (4, 5, 7):
            passage = prose(n, size)
            docs += [prose(30) + " " + passage + " " + prose(20), prose(5) + "x" + passage + "y" + prose(8)]
    docs += [prose(200) for _ in range(10)] + ["abcdefg" * 60 + prose(3)]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(docs)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in cp.suffix_stage(spark, frame, "").collect()}
    assert [got[i] for i in range(len(docs))] == passages(docs)
    changed = [i for i, t in enumerate(docs) if got[i] != t]
    assert 0 not in changed and 12 in changed and 30 in changed and not set(range(42, 52)) & set(changed) and 52 in changed


def test_edges(spark, write_table, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    out = {r["doc_id"]: r["n_tokens"] for r in cp.run(spark, write_table(documents=edge_docs, benchmark=bench)).collect()}
    # copies and texts without a letter are gone, what repeats itself is empty
    assert {d: n > 0 for d, n in out.items()} == {1: True, None: True, 6: False, 8: False}
    assert cp.run(spark, write_table(documents=no_docs, benchmark=bench)).count() == 0
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "tokens"]
    assert suffix_dedup.LENGTH == 400


def test_suffix_stage_keeps_replacement_characters(spark):
    rng = random.Random(2)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(450)
    # \u00e9 and \u00ea share their first byte, \u00e9 and \u0129 their last
    docs = [(1, "one \ufffd\u00e9" + passage + "\u00e9 \ufffd end", 0), (2, "two \u0129" + passage + "\u00ea \ufffd", 0),
            (3, "\ufffd three", 12), (4, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r for r in cp.suffix_stage(spark, frame, "").collect()}
    assert {d: r["text"] for d, r in out.items()} == {1: "one \ufffd \ufffd end", 2: "two  \ufffd", 3: "\ufffd three", 4: None}
    assert [out[d]["n_chars"] for d in (1, 2, 3, 4)] == [11, 6, 12, None]
