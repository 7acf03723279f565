"""Joins to a table of keys that hold under skew, and connected components.

``spread_join`` attaches a table with one row a key to rows of which one key may
hold a third: keys of more than one in ``HOT`` rows are fewer than ``HOT``, so
they are broadcast; rows of all other keys meet them in a shuffle, in which the
rows of hot keys are spread by a hash of the row.

``components`` alternates two steps on the edges until nothing changes: every
node's larger neighbours are linked to its smallest neighbour (large star), then
its smaller neighbours and itself (small star). Stars of any size are counted by
map-side aggregation, edges stay as many as they were, and a chain of n links is
done after about log n rounds. Each round is stored, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import drop_materialised, materialise

HOT = 1000


def spread_join(rows: DataFrame, table: DataFrame, key: str, share: str, total: int) -> DataFrame:
    """Left join of ``table`` (one row for each ``key``) to ``rows``. ``share`` is the table's
    column with the number of rows of a key, ``total`` that of all rows; ``share`` is dropped."""
    values = [c for c in table.columns if c not in (key, share)]
    hot = table.where(F.col(share) * HOT > total).select(
        F.col(key).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values])
    cold = table.where(F.col(share) * HOT <= total).select(F.col(key).alias("_cold"), *values)
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*rows.columns).cast("string"))
    met = met.withColumn("_meet", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(apart))
    met = met.join(cold, F.col("_meet") == F.col("_cold"), "left")
    return met.select(*[F.col(c) for c in rows.columns], *[F.coalesce(f"_hot_{v}", v).alias(v) for v in values])


def _star(edges: DataFrame, name: str) -> DataFrame:
    """For edges (a, b): b joined to the smallest of a and all its b's."""
    total = edges.count()
    least = edges.groupBy("a").agg(F.min("b").alias("_m"), F.count(F.lit(1)).alias("_n"))
    met = spread_join(edges, least.select(F.col("a").alias("_k"), F.least("a", "_m").alias("_m"), "_n").withColumnRenamed(
        "_k", "a"), "a", "_n", total)
    return met.select("a", "b", F.col("_m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")))
                 .first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the edges (a, b), strings: the component is its smallest node."""
    both = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(both, "components")
    state = _state(now)
    while True:
        # large star: a node's larger neighbours to its smallest one
        ways = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(ways, "large").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "components")
        # small star: a node and its smaller neighbours to the smallest of them
        met = _star(large, "small")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            met.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = materialise(small, "components")
        drop_materialised(now, large)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
