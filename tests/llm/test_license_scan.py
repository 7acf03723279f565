import re

from strata.llm import license_scan as ls


def base_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in ls.BASE for i in range(len(w))
          if w[i:i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


TEXTS = [
    "Released UNDER the MIT License. Again: under the mit license!", "Licensed under the Apache License, Version 2.0",
    "Licensed under CC BY-NC 4.0", "cc by nc cc by nc", "under the mit", "license", "Released under the MIT Licence.",
    "This work is licensed undr the GNU General Publik License, version 3", "All rights reserved.", None, "", "É the",
    "Permision is hereby granted, free of charge, to any person obtaining a copy", "x" * 50000 + " under the mit license",
]


def test_query(spark, write_table, edge_docs, no_docs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id long, text string")
    out = ls.op2_fuzzy_license_scan(spark, write_table(documents=docs)).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_places(TEXTS[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["score"] > 0) == bool(r["labels"]) and 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in out}
    assert by[6]["labels"] == "mit" and 0 < by[6]["score"] < 1 and by[6]["n_base"] == 0
    assert by[7]["labels"] == "gpl" and by[8]["labels"] == "all-rights-reserved" and by[12]["labels"] == "mit"
    assert by[9]["labels"] == by[10]["labels"] == "" and by[9]["n_words"] == 0
    assert ls.op2_fuzzy_license_scan(spark, write_table(documents=edge_docs)).count() == edge_docs.count()
    assert ls.op2_fuzzy_license_scan(spark, write_table(documents=no_docs)).count() == 0


def test_every_place_within_the_errors_is_found():
    """Each notice against the regex library on whole texts, with random edits."""
    import random

    import regex
    rng, notices = random.Random(3), ls.Notices()
    for _ in range(150):
        text, _, budget = rng.choice(notices.notices)
        t = list("a b " + text + " c d")
        for _ in range(rng.randint(0, budget + 1)):
            i = rng.randrange(len(t))
            t[i] = rng.choice(["", "x", t[i] + "z"])
        t = "".join(t) + " "
        got = {n for _, n, *_ in notices.search(t, [0, len(t)])}
        want = {n for n, (s, _, k) in enumerate(notices.notices) if regex.search(f"(?:{regex.escape(s)}){{e<={k}}}", t)}
        assert got == want


def test_spans_are_bytes_of_the_text(spark):
    text = "Ünï: released into the public domain, yes"
    row = ls.scan_licenses(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    m = row["matches"][0]
    assert text.encode()[m["first_byte"]:m["end_byte"]] == b"released into the public domain" and m["errors"] == 0


def test_equal_notices_side_by_side_all_come_back(spark):
    notice = "released into the public domain"
    near = "released into teh public domain"
    text = f"{notice} {notice}. {near}, {notice}; {near} {near} and more"
    row = ls.scan_licenses(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    found = [(text[m["first_byte"]:m["end_byte"]], m["errors"]) for m in row["matches"] if m["label"] == "public-domain"]
    assert [t for t, _ in found] == [notice, notice, near, notice, near, near]
    assert [e for _, e in found] == [0, 0, 2, 0, 2, 2] and row["labels"] == "public-domain" and row["score"] == 1.0
