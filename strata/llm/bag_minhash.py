"""Near-duplicate groups by BagMinHash over multisets of five-word shingles.

*Signature.* A text is the multiset of its shingles; a shingle's weight is its
count. Each (shingle, dyadic weight interval [0,1), [1,2), [2,4), ...) owns a
Poisson process with the interval's width as rate, seeded by the shingle's
hash. A point has an arrival time, a register, and a unit cell of its
interval (the hierarchy: a coarse process splits into those of its cells); it
counts for a text if the cell lies below the shingle's weight. A register
keeps the earliest time, so two texts agree in a register with the
probability of their weighted Jaccard similarity. All points up to a time
that fills the registers with near certainty are drawn; a text with an empty
register is drawn again with twice the time.

*Candidates.* 32 bands of 4 registers: a pair at similarity 0.8 misses all of
them with probability 5e-8. Pairs are never enumerated in a bucket: every
member is compared with the bucket's hub. Components of verified pairs are
found, and members of buckets that still span several components meet other
hubs in further rounds. What is left after these is compared in blocks of a
bounded number of members, component against component, inside tasks that
return only verified pairs.

*Verification* is exact: sum of minimum over sum of maximum counts >= 0.8.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased; a text with one to four words is one shingle. Texts without a
word (null and empty ones too) are groups of their own. Equal texts are one
item, whatever their number; repeated rows are copies. Extra columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, released, ship, stored, table, text_digest, text_slices
from .textcore import ALNUM, U, Words, mix, shingles

REGISTERS, BANDS = 128, 32
SHINGLE, SIMILARITY = 5, 0.8
HUB_ROUNDS = 2
#: Members, and bytes of their shingles, of one side in a block comparison.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
_TEXT_BYTES = 3 << 20


def multisets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), ordered by text and hash."""
    text, h = shingles(Words(texts, True, ALNUM), k)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    if not len(h):
        return text, h, np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1]))))
    return text[first], h[first], np.diff(np.append(first, len(h)))


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(text: np.ndarray, h: np.ndarray, count: np.ndarray, n_texts: int,
               m: int = REGISTERS) -> np.ndarray:
    """Registers (n_texts x m) of the earliest arrival times; inf for a text without shingles."""
    out = np.full(n_texts * m, np.inf)
    weight = np.bincount(text, weights=count, minlength=n_texts)
    until = np.divide(m * (np.log(m) + 9), weight, out=np.zeros(n_texts), where=weight > 0)
    levels = [np.arange(len(h))]
    lower, rate = [np.zeros(len(h))], [np.ones(len(h))]
    low = 1
    while len(i := np.flatnonzero(count > low)):
        levels.append(i)
        lower.append(np.full(len(i), float(low)))
        rate.append(np.full(len(i), float(low)))
        low *= 2
    element = np.concatenate(levels)
    lower, rate = np.concatenate(lower), np.concatenate(rate)
    seed = mix(h[element] + (lower * 2).astype(U) * U(0x9E3779B97F4A7C15))
    todo = np.ones(n_texts, dtype=bool)
    while True:
        a = np.flatnonzero(todo[text[element]])
        own, s, r, lo, top, cut = (text[element[a]], seed[a], rate[a], lower[a], count[element[a]],
                                   until[text[element[a]]])
        x = np.zeros(len(a))
        step = 0
        while len(own):
            step += 1
            u = mix(s + U(step * 0x632BE59BD9B4E019 & (2 ** 64 - 1)))
            x = x - np.log(_unit(u)) / r
            live = x <= cut
            if not live.all():
                own, s, r, lo, top, cut, x, u = (v[live] for v in (own, s, r, lo, top, cut, x, u))
            v = mix(u + U(1))
            here = lo + np.floor(_unit(mix(v)) * r) < top
            reg = (v % U(m)).astype(np.int64)
            np.minimum.at(out, own[here] * m + reg[here], x[here])
        todo = (weight > 0) & np.isinf(out.reshape(n_texts, m)).any(axis=1)
        if not todo.any():
            return out.reshape(n_texts, m)
        until[todo] *= 2


def band_keys(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit bucket of each band."""
    n, m = registers.shape
    r = registers.view(U).reshape(n, bands, m // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * U(0xD6E8FEB86659FD93), (n, bands))
    for j in range(m // bands):
        key = mix(key ^ r[:, :, j]) + U(j)
    return key.view(np.int64)


@released
def _bands(batches):
    for batch in batches:
        for lo, hi, texts in text_slices(batch, 1, _TEXT_BYTES):
            t, h, c = multisets(texts)
            has = np.bincount(t, minlength=hi - lo) > 0
            keys = band_keys(signatures(t, h, c, hi - lo))[has]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).filter(pa.array(has)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))],
                names=["item", "bands"])


@released
def _packed(batches):
    """(item, sorted shingle hashes as bytes, their counts as bytes)."""
    for batch in batches:
        for lo, hi, texts in text_slices(batch, 1, _TEXT_BYTES):
            t, h, c = multisets(texts)
            at = np.searchsorted(t, np.arange(hi - lo + 1))
            c = c.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo),
                 pa.array([h[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                 pa.array([c[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())],
                names=["item", "hashes", "counts"])


def similarity(h1, c1, h2, c2) -> float:
    """Weighted Jaccard of two multisets given as sorted hashes and counts."""
    at = np.searchsorted(h2, h1)
    at[at == len(h2)] = 0
    both = h2[at] == h1 if len(h2) else np.zeros(len(h1), dtype=bool)
    low = int(np.minimum(c1[both], c2[at[both]]).sum())
    return low / max(1, int(c1.sum()) + int(c2.sum()) - low)


def _pack(hashes: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """A packed multiset as arrays over the batch's own memory."""
    return np.frombuffer(hashes.as_buffer(), U), np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)


@released
def _verify(batches):
    for batch in batches:
        a, b, h1, c1, h2, c2 = (batch.column(i) for i in range(6))
        ok = [similarity(*_pack(h1[i], c1[i]), *_pack(h2[i], c2[i])) >= SIMILARITY for i in range(batch.num_rows)]
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])


def _compare_blocks(group: pa.Table) -> pa.Table:
    """Verified pairs of one block pair, each only in its first common bucket."""
    bucket, i, j = (group.column(n)[0].as_py() for n in ("bucket", "i", "j"))
    items, comp, block = (group.column(n).to_pylist() for n in ("item", "comp", "block"))
    bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
    packs = [_pack(x, y) for x, y in zip(group.column("hashes"), group.column("counts"), strict=True)]
    h, c = [x for x, _ in packs], [x for _, x in packs]
    weight = np.array([int(x.sum()) for x in c])
    a, b = [], []
    left = [x for x in range(len(items)) if block[x] == i]
    right = np.array([x for x in range(len(items)) if block[x] == j], dtype=np.int64)
    here = int(np.argmax(bands[0] == bucket)) if len(bands) else 0
    for x in left:
        other = right[right > x] if i == j else right
        if not len(other):
            continue
        first = np.argmax(bands[other] == bands[x], axis=1) == here
        fit = np.minimum(weight[other], weight[x]) >= SIMILARITY * np.maximum(weight[other], weight[x])
        for y in other[first & fit]:
            if comp[x] != comp[y] and similarity(h[x], c[x], h[y], c[y]) >= SIMILARITY:
                a.append(items[x])
                b.append(items[y])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(item, comp): smallest item of each connected component of (a, b).

    Every round takes the smallest label among the neighbours and then jumps
    to that label's label; labels are written to the shared folder.
    """
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    label = stored(spark, both.groupBy(F.col("a").alias("item")).agg(F.min("b").alias("n")).select(
        "item", F.least("item", "n").alias("comp")), "components")
    while True:
        near = both.join(label, both["b"] == label["item"]).groupBy("a").agg(F.min("comp").alias("near"))
        lower = label.join(near, label["item"] == near["a"]).select(
            "item", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        jump = label.select(F.col("item").alias("via"), F.col("comp").alias("next"))
        step = stored(spark, lower.join(jump, lower["comp"] == jump["via"], "left").select(
            "item", F.least("comp", "next").alias("comp"), "was"), "components")
        discard(spark, label)
        label = step.select("item", "comp")
        if step.where("comp != was").isEmpty():
            return label


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(item, one, n_docs): for each digest of a text with words, the first
    document (doc_id, digest) of its group and the group's number of rows."""
    ship(spark)
    kept: list[DataFrame] = []

    def hold(df: DataFrame, name: str) -> DataFrame:
        kept.append(stored(spark, df, name))
        return kept[-1]

    rows = docs.select("doc_id", text_digest(F.col("text")).alias("item"), "text")
    texts = hold(rows.groupBy("item").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "near-texts")
    sig = hold(rows.select("item", "text").mapInArrow(_bands, "item binary, bands array<long>")
               .dropDuplicates(["item"]), "near-bands")
    in_band = sig.select(F.explode("bands").alias("bucket"), "item")
    full = in_band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    member = hold(in_band.join(full, "bucket"), "near-members")

    wanted = texts.join(member.select("item").distinct(), "item").select(F.col("item").alias("w"), F.col("first").alias("f"))
    body = rows.join(wanted, (F.col("item") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("f")))
    packs = hold(body.select("item", "text").mapInArrow(
        _packed, "item binary, hashes binary, counts binary").dropDuplicates(["item"]), "near-packs")

    left = packs.select(F.col("item").alias("a"), F.col("hashes").alias("h1"), F.col("counts").alias("c1"))
    right = packs.select(F.col("item").alias("b"), F.col("hashes").alias("h2"), F.col("counts").alias("c2"))
    edges = seen = comp = None
    for turn in range(HUB_ROUNDS):
        now = member.withColumn("comp", F.col("item")) if comp is None else _with_comp(member, comp)
        hub = now.groupBy("bucket").agg(
            F.min(F.struct(F.xxhash64("item", F.lit(turn)).alias("o"), "item", "comp")).alias("hub"),
            F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2").select("bucket", "hub")
        pairs = now.join(hub, "bucket").where("comp != hub.comp").select(
            F.least("item", "hub.item").alias("a"), F.greatest("item", "hub.item").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = hold(pairs, "near-pairs")
        if pairs.isEmpty():
            break
        seen = pairs if seen is None else seen.union(pairs)
        more = hold(pairs.join(left, "a").join(right, "b").select("a", "b", "h1", "c1", "h2", "c2").mapInArrow(
            _verify, "a binary, b binary"), "near-edges")
        edges = more if edges is None else edges.union(more)
        comp = components(spark, edges)
        kept.append(comp)
    if comp is not None:
        more = hold(_block_edges(member, comp, packs, sig), "near-edges")
        if not more.isEmpty():
            comp = components(spark, edges.union(more))
            kept.append(comp)

    # a text without words is a group of its own, however often it occurs
    grouped = _with_comp(texts, comp) if comp is not None else texts.withColumn("comp", F.col("item"))
    grouped = grouped.join(sig.select(F.col("item").alias("s")), F.col("item") == F.col("s"), "left_semi")
    group = grouped.groupBy("comp").agg(
        F.min(F.struct(F.col("first").isNull().alias("none"), "first", "item")).alias("one"), F.sum("n").alias("n_docs"))
    out = stored(spark, grouped.select("item", "comp").join(group, "comp").select("item", "one", "n_docs"), "near-groups")
    discard(spark, *kept)
    return out


def _with_comp(df: DataFrame, comp: DataFrame) -> DataFrame:
    return df.join(comp, "item", "left").withColumn("comp", F.coalesce("comp", "item"))


def _block_edges(member: DataFrame, comp: DataFrame, packs: DataFrame, sig: DataFrame) -> DataFrame:
    """Verified pairs of members of one bucket that are still in different components.

    A bucket is dealt into blocks of bounded members and bytes; a task compares
    two blocks and returns only pairs that are similar.
    """
    sizes = packs.select("item", (F.octet_length("hashes") + F.octet_length("counts")).alias("size"))
    now = _with_comp(member, comp)
    mixed = now.join(sizes, "item").groupBy("bucket").agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("size")).where("c1 != c2").select(
        "bucket", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = now.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "item", "comp", "block")
    return spread.join(sig, "item").join(packs, "item").groupBy("bucket", "i", "j").applyInArrow(
        _compare_blocks, "a binary, b binary").distinct()


def op7_bag_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    group = near_duplicates(spark, docs)
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("item"))
    return rows.join(group, "item", "left").select(
        "doc_id", F.coalesce("one.first", "doc_id").alias("class_id"),
        F.coalesce("n_docs", F.lit(1)).alias("class_size"))


def near_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without near copies, all columns kept: the one with the
    smallest doc_id of each group stays (the smaller digest, then any, among
    equal ids)."""
    group = near_duplicates(spark, docs).where("n_docs > 1").select(F.col("item").alias("own"), "one")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"),
                       text_digest(F.col("text")).alias("digest"))
    joined = rows.join(group, F.col("digest") == F.col("own"), "left")
    kept = joined.where("one is null or (digest = one.item and id <=> one.first)")
    repeated = rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(
        group, F.col("digest") == F.col("own"), "left_semi").select(F.col("id").alias("id2"), F.col("digest").alias("digest2"))
    if not repeated.isEmpty():
        twice = F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2"))
        one = kept.join(repeated, twice, "left_semi").dropDuplicates(["id", "digest"])
        kept = kept.join(repeated, twice, "left_anti").unionByName(one)
    return kept.select("row.*")
