"""WARC archives: a deterministic sharded writer, and a reader.

The bytes of an archive depend on the pages and the parameters only, not on how
the rows were dealt, on the clock or on task retries:

1. *Decide.* Pages are counted by (page_id, url, payload digest, size). The row
   with the largest page_id (then url) of each payload is its response, all
   others revisit it; payloads below ``least`` bytes are all responses. Only
   payloads that may occur twice (a bitmap of ``MARKS`` bits by digest says which
   cannot) are shuffled for this, copies combined before. A payload with more than one in ``HOT`` of all rows meets its rows
   by a broadcast (there are fewer than ``HOT`` of them), others by a join.
2. *Compress.* Each response becomes one gzip member with new HTTP and WARC
   headers and digests.
3. *Range sort.* Shards are ranges of (page_id, url, digest, occurrence). Their
   bounds come from a sample of rows chosen by a hash of the row, with odds in
   proportion to its bytes; repeated rows are split by occurrence, so every
   shard is bounded. A shard is at least ``shard_bytes`` on average, and more
   only if there would be over ``MOST_SHARDS``.
4. *Write.* One task sorts and writes a shard and starts a new file when the
   compressed size reaches ``file_bytes``. It writes under temporary names and
   returns a manifest row for each file; only the rows of successful tasks
   reach the manifest.
5. *Commit.* Files of the manifest are moved to their final names (again after
   a failure without harm), then the manifest is written: archives without a
   manifest are unfinished. What lost attempts left behind is deleted.

The reader deals out blocks of files that the manifest lists, checks lengths
and digests of every record, and gives one row a record.

A null html is an empty payload; equal empty payloads are equal payloads. A
null page_id is the smallest, a null url too, and both stay null. Repeated rows
are records of their own: one response, the others revisit it (refers_to is
their own page_id then). Texts of any length go whole into one record. An empty
table gives archives without records. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, discard, released, ship, stored, table

#: Payload bytes of a shard, and compressed bytes at which a file is closed.
SHARD_BYTES, FILE_BYTES = 16 << 20, 256 << 20
#: Most shards; rows of the sample for each shard's bounds.
MOST_SHARDS, SAMPLES = 10_000, 16
#: Compressed bytes that the reader handles at once, and repeats of a row that are kept together.
BLOCK_BYTES, REPEATS = 4 << 20, 4096
HOT = 1000
#: Bits (a power of two) of the map of digests that occur twice; it is what is broadcast.
MARKS = 1 << 26
#: Bytes that a record has besides its payload, about.
HEADERS = 600
#: Records carry this date: the writer does not read the clock.
DATE = "2000-01-01T00:00:00Z"
_IDS = uuid.UUID("6f9619ff-8b86-d011-b42d-00c04fc964ff")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, url, sha: str, occurrence: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, json.dumps([page_id, url, sha, occurrence]))}>"


def _url_fields(prefix: str, url: str | None) -> list[tuple[str, str]]:
    """The address as a header, percent-encoded where it has to be (then also as it was)."""
    if url is None:
        return []
    safe = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")
    return [(f"WARC-{prefix}Target-URI", safe)] + ([(f"WARC-X-{prefix}Url", json.dumps(url))] if safe != url else [])


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _fields(kind: str, page_id, url, sha: str, occurrence: int, block: bytes, date: str) -> list[tuple[str, str]]:
    out = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, url, sha, occurrence)), ("WARC-Date", date),
           *_url_fields("", url)]
    if page_id is not None:
        out.append(("WARC-X-Page-ID", str(page_id)))
    return out + [("Content-Type", "application/http; msgtype=response"),
                  ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
                  ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha)).decode())]


def response_record(page_id, url, sha: str, occurrence: int, payload: bytes, date: str) -> bytes:
    block = _http(len(payload)) + payload
    return _member(_fields("response", page_id, url, sha, occurrence, block, date), block)


def revisit_record(page_id, url, sha: str, occurrence: int, size: int, to_id, to_url, date: str) -> bytes:
    block = _http(size)
    fields = _fields("revisit", page_id, url, sha, occurrence, block, date)
    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(to_id, to_url, sha, 0)),
               *_url_fields("Refers-To-", to_url), ("WARC-Refers-To-Date", date)]
    if to_id is not None:
        fields.append(("WARC-X-Refers-To-Page-ID", str(to_id)))
    return _member(fields, block)


def info_record(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_IDS, name)}>"),
                    ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ("WARC-Block-Digest", "sha1:" + base32_sha1(block))], block)


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha", pa.string()), ("size", pa.int64()),
                    ("first", pa.int64()), ("times", pa.int64()), ("to_id", pa.int64()), ("to_url", pa.string()),
                    ("packed", pa.binary())])
RECORD_SQL = ("page_id long, url string, sha string, size long, first long, times long, to_id long, to_url string, "
              "packed binary")


def _packed(date: str):
    """Rows (page_id, url, sha, size, first, times, html) as compressed responses, one a repeat."""
    @released
    def run(batches):
        for batch in batches:
            out, held = [], 0
            for page, url, sha, size, first, times, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                for k in range(first, first + times):
                    gz = response_record(page, url, sha, k, payload, date)
                    out.append((page, url, sha, size, k, 1, None, None, gz))
                    held += len(gz)
                    if held > 4 << 20:
                        yield _batch(out, RECORD)
                        out, held = [], 0
            if out:
                yield _batch(out, RECORD)
    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows), schema, strict=True)],
                                      schema=schema)


def _records(spark: SparkSession, pages: DataFrame, keyed: DataFrame, total: int, least: int, date: str) -> DataFrame:
    """All records: responses as compressed bytes, revisits as what their headers need."""
    key = ["page_id", "url", "sha", "size"]
    large, small = F.col("size") >= least, F.col("size") < least
    own = F.struct("page_id", "url")
    tops = keyed.where(large).groupBy("sha", "size").agg(F.max(own).alias("top"), F.sum("times").alias("copies"))
    tops = tops.where("copies > 1").select(F.col("sha").alias("top_sha"), "top", "copies")
    hot = tops.where(F.col("copies") * HOT > total).select(F.col("top_sha").alias("hot_sha"), F.col("top").alias("hot_top"))
    met = keyed.where(large).join(F.broadcast(hot), F.col("sha") == F.col("hot_sha"), "left")
    # rows of hot payloads are spread over keys that no payload has
    apart = F.concat(F.lit("-"), F.xxhash64(*key).cast("string"))
    met = met.withColumn("meet", F.when(F.col("hot_sha").isNull(), F.col("sha")).otherwise(apart))
    met = met.join(tops, F.col("meet") == F.col("top_sha"), "left").withColumn("to", F.coalesce("hot_top", "top"))
    twice = met.where(F.col("to").isNotNull())
    is_top = F.col("to").eqNullSafe(own)
    revisits = twice.withColumn("own", is_top).select(
        *key, F.when(F.col("own"), _first_free("times")).otherwise(_all("times")).alias("parts"),
        F.col("to.page_id").alias("to_id"), F.col("to.url").alias("to_url"))
    revisits = revisits.select(*key, F.explode("parts").alias("p"), "to_id", "to_url").select(
        *key, "p.first", "p.times", "to_id", "to_url", F.lit(None).cast("binary").alias("packed"))

    perhaps = _marked(spark, tops.select(F.col("top_sha").alias("sha")))
    first, times = F.lit(0).cast("long").alias("first"), F.lit(1).cast("long").alias("times")
    one = pages.where(large & perhaps("sha")).groupBy("sha", "size").agg(
        F.max(own).alias("top"), F.any_value("html").alias("html"))
    kept = one.select("top.page_id", "top.url", "sha", "size", first, times, "html").unionByName(
        pages.where(large & ~perhaps("sha")).select(*key, first, times, "html"))
    if least > 0:
        each = pages.where(small).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.any_value("html").alias("html"))
        each = each.select(*key, F.explode(_all("n")).alias("p"), "html")
        kept = kept.unionByName(each.select(*key, "p.first", "p.times", "html"))
    return kept.mapInArrow(_packed(date), RECORD_SQL).unionByName(revisits)


def _mark(sha):
    """Place of a digest in the map of marks, from 1."""
    return F.shiftright(F.conv(F.substring(sha, 1, 8), 16, 10).cast("long"), 32 - (MARKS.bit_length() - 1)) + 1


def _marked(spark: SparkSession, twice: DataFrame):
    """A test that holds for all digests of ``twice`` and few others."""
    mark = _mark("sha")
    rows = twice.groupBy(F.bitmap_bucket_number(mark).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(mark)).alias("bits")).collect()
    size = len(rows[0]["bits"]) if rows else 1
    bits = np.zeros(max(MARKS // 8, size), dtype=np.uint8)
    for r in rows:
        bits[(r["bucket"] - 1) * size:r["bucket"] * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def perhaps(mark: pa.Array) -> pa.Array:
        at = mark.to_numpy(zero_copy_only=False) - 1
        return pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))
    return lambda sha: perhaps(_mark(sha))


def _parts(count: str, first: int):
    step = F.lit(REPEATS).cast("long")
    start = F.sequence(F.lit(first).cast("long"), F.col(count) - 1, step)
    parts = F.transform(start, lambda s: F.struct(s.alias("first"), F.least(step, F.col(count) - s).alias("times")))
    return F.when(F.col(count) > first, parts)


def _all(count: str):
    return _parts(count, 0)


def _first_free(count: str):
    """All repeats but the first one, which is the response."""
    return _parts(count, 1)


def _order(page_id, url, sha, first) -> tuple:
    return (page_id is not None, page_id or 0, url is not None, url or "", sha, first)


def shard_bounds(keyed: DataFrame, weight: int, shards: int) -> list[tuple]:
    """First keys of all shards but the first, from a sample by a hash of the rows."""
    if shards == 1:
        return []
    bytes_of = F.col("p.times") * HEADERS + F.when(F.col("p.first") == 0, F.col("size")).otherwise(0)
    rows = keyed.select("page_id", "url", "sha", "size", F.explode(_all("times")).alias("p"))
    drawn = F.pmod(F.xxhash64("page_id", "url", "sha", "p.first"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(drawn < bytes_of * (shards * SAMPLES / max(weight, 1))).select(
        "page_id", "url", "sha", F.col("p.first").alias("first")).collect()
    keys = sorted(_order(*r) for r in sample)
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else []


MANIFEST = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("temporary", pa.string()),
                      ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
                      ("blocks", pa.list_(pa.int64()))])
MANIFEST_SQL = ("shard int, seq int, name string, temporary string, records long, bytes long, sha256 string, "
                "blocks array<long>")


class _Files:
    """The files of one shard: one after the other, under temporary names."""

    def __init__(self, root: str, shard: int, file_bytes: int, date: str):
        self.files, self.base = fs.FileSystem.from_uri(root)
        self.shard, self.limit, self.date, self.attempt = shard, file_bytes, date, uuid.uuid4().hex
        self.done: list[tuple] = []
        self.out = None

    def add(self, record: bytes) -> None:
        if self.out is not None and self.size >= self.limit:
            self.close()
        if self.out is None:
            seq = len(self.done)
            self.name = f"shard-{self.shard:05d}-{seq:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.files.create_dir(f"{self.base}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
            self.size, self.records, self.digest, self.blocks = 0, -1, hashlib.sha256(), [0]
            self._write(info_record(self.name, self.date))
        if self.size - self.blocks[-1] >= BLOCK_BYTES:
            self.blocks.append(self.size)
        self._write(record)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, len(self.done), self.name, self.temporary, self.records, self.size,
                              self.digest.hexdigest(), self.blocks))
            self.out = None


def _write_shard(root: str, file_bytes: int, date: str):
    @released
    def run(batches):
        files = None
        for batch in batches:
            for shard, page, url, sha, size, first, times, to_id, to_url, packed in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if files is None:
                    files = _Files(root, shard, file_bytes, date)
                if packed is not None:
                    files.add(packed)
                    continue
                for k in range(first, first + times):
                    files.add(revisit_record(page, url, sha, k, size, to_id, to_url, date))
        if files:
            files.close()
            yield _batch(files.done, MANIFEST)
    return run


def _move(root: str):
    def run(batches):
        files, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for temporary, name in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
                # a repeated task finds some of its files moved already
                if files.get_file_info(f"{base}/{temporary}").type != fs.FileType.NotFound:
                    files.move(f"{base}/{temporary}", f"{base}/{name}")
            yield batch
    return run


@dataclass
class Archives:
    root: str
    manifest: DataFrame


def write_archives(spark: SparkSession, pages: DataFrame, root: str | None = None, least: int = 0, date: str = DATE,
                   shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> Archives:
    """Write a record for each row of ``pages`` (page_id, url, html) into archives under ``root``.

    ``root`` is a path or address that Spark and pyarrow both reach; by default a
    new folder under the shared one. A root that has a manifest is not written again.
    """
    ship(spark)
    root = root or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    files, base = fs.FileSystem.from_uri(root)
    if files.get_file_info(f"{base}/MANIFEST/_SUCCESS").type != fs.FileType.NotFound:
        raise ValueError(f"{root} holds finished archives")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.sha1(html).alias("sha"),
                         F.octet_length(html).cast("long").alias("size"), "html")
    keyed = stored(spark, pages.groupBy("page_id", "url", "sha", "size").agg(F.count(F.lit(1)).alias("times")), "warc-keys")
    total, weight = keyed.agg(F.sum("times"), F.sum(F.col("size") + F.col("times") * HEADERS)).first()
    shards = min(MOST_SHARDS, max(1, -(-(weight or 0) // shard_bytes)))
    bounds = spark.sparkContext.broadcast(shard_bounds(keyed, weight or 0, shards))

    @F.arrow_udf("int")
    def shard_of(page_id: pa.Array, url: pa.Array, sha: pa.Array, first: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (page_id, url, sha, first)))
        return pa.array([bisect_right(bounds.value, _order(*r)) for r in rows], pa.int32())

    records = _records(spark, pages, keyed, total or 0, least, date)
    dealt = records.select(shard_of("page_id", "url", "sha", "first").alias("shard"), "*")
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("page_id", "url", "sha", "first")
    written = stored(spark, dealt.mapInArrow(_write_shard(root, file_bytes, date), MANIFEST_SQL), "warc-written")
    moved = written.mapInArrow(_move(root), MANIFEST_SQL).drop("temporary")
    moved.write.parquet(f"{root}/MANIFEST")
    discard(spark, keyed, written)
    if files.get_file_info(f"{base}/_temporary").type != fs.FileType.NotFound:
        files.delete_dir(f"{base}/_temporary")
    return Archives(root, spark.read.schema(moved.schema).parquet(f"{root}/MANIFEST"))


def members(stream, size: int = 1 << 20):
    """The uncompressed gzip members of a stream, one after the other."""
    rest = b""
    while True:
        rest = rest or stream.read(size)
        if not rest:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest and not (rest := stream.read(size)):
                raise ValueError("an archive ends within a record")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    block = record[end + 4:end + 4 + size]
    if len(block) != size or record[end + 4 + size:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its header")
    if fields["WARC-Block-Digest"] != "sha1:" + base32_sha1(block):
        raise ValueError("a block differs from its digest")
    return fields, block


READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                  ("record_id", pa.string()), ("refers_to_record", pa.string()), ("payload", pa.string())])
READ_SQL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, record_id string, refers_to_record string, payload string")


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("a payload differs from its headers")
    number = lambda name: int(fields[name]) if name in fields else None
    url = json.loads(fields["WARC-X-Url"]) if "WARC-X-Url" in fields else fields.get("WARC-Target-URI")
    return (number("WARC-X-Page-ID"), url, size, digest, kind, number("WARC-X-Refers-To-Page-ID"),
            fields["WARC-Record-ID"], fields.get("WARC-Refers-To"),
            payload.decode() if payloads and kind == "response" else None)


def _read_blocks(root: str, payloads: bool):
    @released
    def run(batches):
        files, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, held = [], 0
                with files.open_input_file(f"{base}/{name}") as f:
                    part = pa.BufferReader(f.read_at(end - begin, begin))
                for record in members(part):
                    fields, block = parse(record)
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    out.append(_row(fields, block, payloads))
                    held += len(record) if payloads else 1000
                    if held > 8 << 20:
                        yield _batch(out, READ)
                        out, held = [], 0
                if out:
                    yield _batch(out, READ)
    return run


def read_archives(spark: SparkSession, archives: Archives, payloads: bool = False) -> DataFrame:
    """A row for each response and revisit; ``payloads`` adds the text of responses (else null)."""
    ship(spark)
    ends = F.concat(F.slice("blocks", 2, F.size("blocks")), F.array("bytes"))
    blocks = archives.manifest.select("name", F.explode(F.arrays_zip(F.col("blocks").alias("begin"), ends.alias("end")))
                                      .alias("b")).select("name", "b.begin", "b.end")
    n = archives.manifest.agg(F.sum(F.size("blocks"))).first()[0] or 1
    dealt = blocks.repartition(min(n, MOST_SHARDS), "name", "begin")
    return dealt.mapInArrow(_read_blocks(archives.root, payloads), READ_SQL)


def op12_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(spark, table(spark, sf_dir, "pages"))
    return read_archives(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Four bits of each hexadecimal digit of the digest.
_BITS = ("[substr('0000000100100011010001010110011110001001101010111100110111101111', "
         "4 * strpos('0123456789abcdef', substr(h, CAST(j AS INT), 1)) - 3, 4) FOR j IN range(1, 41)]")
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS h, strlen(html) AS payload_bytes,
        row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place,
        max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (SELECT *, array_to_string({_BITS}, '') AS bits FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(substr(bits, i + 1, 1) AS INT) + 8 * CAST(substr(bits, i + 2, 1) AS INT)
      + 4 * CAST(substr(bits, i + 3, 1) AS INT) + 2 * CAST(substr(bits, i + 4, 1) AS INT)
      + CAST(substr(bits, i + 5, 1) AS INT) AS INT), 1) FOR i IN range(0, 160, 5)], '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN top END AS refers_to
FROM b"""
