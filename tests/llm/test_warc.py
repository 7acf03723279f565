import gzip
import hashlib
import os

import duckdb
import pytest

from strata.llm import warc

PAGES = "page_id long, url string, html string"


def some_pages():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<p>{i}</p>" + "text é " * (i % 50)) for i in range(200)]
    rows += [(1000 + i, f"http://copy.example/{i}", "<p>the same</p>") for i in range(300)]
    rows += [(5000, "http://a.example/", "<p>row</p>")] * 40  # repeated rows
    rows += [(2000, None, None), (2001, "", ""), (None, "http://null.example/", "<p>none</p>"), (None, None, "<p>the same</p>"),
             (2002, "http://x.example/a b\r\nX: yé%20", "<p>odd address</p>"), (2003, "u", "x" * 3_000_000)]
    return rows


def expected(rows, least=0):
    top = {}
    for page, url, html in rows:
        top[html or ""] = max(top.get(html or "", (-1, "")), (-1 if page is None else page, url or ""))
    used, out = set(), []
    for page, url, html in rows:
        t = html or ""
        data = t.encode()
        first = (-1 if page is None else page, url or "") == top[t] and t not in used
        if first:
            used.add(t)
        to = None if top[t][0] < 0 else top[t][0]
        small = len(data) < least
        out.append((page, len(data), warc.base32_sha1(data), "response" if first or small else "revisit",
                    None if first or small else to))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_query_equals_definition_and_oracle(spark, write_table):
    rows = some_pages()
    base = write_table(pages=spark.createDataFrame(rows, PAGES).repartition(4))
    got = ordered(warc.op12_sharded_warc(spark, base).select(*COLUMNS).collect())
    assert got == ordered(expected(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{base}/pages.parquet/*.parquet')")
    assert got == ordered(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({warc.ORACLE})").fetchall())


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = some_pages()
    out = warc.write_archives(spark, spark.createDataFrame(rows, PAGES), str(tmp_path / "w"), least=12)
    got = warc.read_archives(spark, out).select(*COLUMNS).collect()
    assert ordered(got) == ordered(expected(rows, 12))


def files(root):
    return {n: hashlib.sha256(open(os.path.join(root, n), "rb").read()).hexdigest()
            for n in os.listdir(root) if n.endswith(".gz")}


def test_archives_do_not_depend_on_how_rows_were_dealt(spark, tmp_path):
    rows = some_pages()
    made = []
    for i, df in enumerate((spark.createDataFrame(rows, PAGES).repartition(3),
                            spark.createDataFrame(rows[::-1], PAGES).repartition(7))):
        root = str(tmp_path / f"w{i}")
        out = warc.write_archives(spark, df, root, shard_bytes=60_000, file_bytes=4_000)
        made.append(files(root))
        listed = {r["name"]: r for r in out.manifest.collect()}
        assert {n: r["sha256"] for n, r in listed.items()} == made[-1]
        assert not os.path.exists(os.path.join(root, "_temporary"))
        assert sum(r["records"] for r in listed.values()) == len(rows)
        assert max(r["seq"] for r in listed.values()) > 0 and len({r["shard"] for r in listed.values()}) > 5
    assert made[0] == made[1]
    with pytest.raises(ValueError, match="finished"):
        warc.write_archives(spark, spark.createDataFrame(rows, PAGES), str(tmp_path / "w0"))


def test_pages_come_back_in_order_with_their_payloads(spark, tmp_path, monkeypatch):
    rows = some_pages()
    root = str(tmp_path / "w")
    out = warc.write_archives(spark, spark.createDataFrame(rows, PAGES), root)
    back = warc.read_archives(spark, out, payloads=True).collect()
    by_id = {r["record_id"]: r for r in back}
    assert len(by_id) == len(rows)
    texts = sorted((str(r["page_id"]), str(r["url"]), by_id[r["refers_to_record"] or r["record_id"]]["payload"]) for r in back)
    assert texts == sorted((str(p), str(u), h or "") for p, u, h in rows)
    order, text = [], b""
    for name in sorted(files(root)):
        text = gzip.open(os.path.join(root, name)).read()
        order += [x.split(b"\r\n")[0] for x in text.split(b"WARC-X-Page-ID: ")[1:]]
    assert [int(x) for x in order] == sorted(p for p, _, _ in rows if p is not None)
    assert b"a%20b%0D%0AX:%20y" in text or any(b"a%20b%0D%0AX:%20y" in gzip.open(os.path.join(root, n)).read() for n in files(root))


def test_a_full_map_of_marks_changes_nothing(spark, tmp_path, monkeypatch):
    rows = some_pages()
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.write_archives(spark, df, str(tmp_path / "a"))
    monkeypatch.setattr(warc, "MARKS", 1 << 3)
    warc.write_archives(spark, df, str(tmp_path / "b"))
    assert files(str(tmp_path / "a")) == files(str(tmp_path / "b"))


def test_a_changed_byte_is_found(spark, tmp_path):
    root = str(tmp_path / "w")
    out = warc.write_archives(spark, spark.createDataFrame([(1, "u", "<p>one</p>")], PAGES), root)
    name = next(iter(files(root)))
    data = gzip.open(os.path.join(root, name)).read()
    head, page = data[:data.index(b"WARC/1.1", 10)], data[data.index(b"WARC/1.1", 10):]
    with open(os.path.join(root, name), "wb") as f:
        f.write(gzip.compress(head) + gzip.compress(page.replace(b"<p>one", b"<p>two")))
    size = os.path.getsize(os.path.join(root, name))
    changed = warc.Archives(root, spark.createDataFrame([(name, size, [0])], "name string, bytes long, blocks array<long>"))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, changed).collect()


def test_empty_table_and_clashing_columns(spark, tmp_path):
    out = warc.write_archives(spark, spark.createDataFrame([], PAGES), str(tmp_path / "e"))
    assert warc.read_archives(spark, out).count() == 0
    rows = [(1, "u", "h", "s", 1, 2, "t", 3, 4, "b")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, sha string, size long, first int, top string, "
                                     "times long, shard int, meet string")
    out = warc.write_archives(spark, df, str(tmp_path / "c"))
    assert [tuple(r)[:3] for r in warc.read_archives(spark, out).collect()] == [(1, "u", 1)]


def test_hot_payload_meets_its_rows(spark, tmp_path):
    rows = [(i, "http://one.example/", "<p>hot</p>") for i in range(3000)] + [(9000 + i, "v", f"{i}") for i in range(50)]
    out = warc.write_archives(spark, spark.createDataFrame(rows, PAGES).repartition(6), str(tmp_path / "h"), shard_bytes=200_000)
    got = warc.read_archives(spark, out).collect()
    assert sum(r["record_type"] == "revisit" and r["refers_to"] == 2999 for r in got) == 2999
    assert len({r["shard"] for r in out.manifest.collect()}) > 4
