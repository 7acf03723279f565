"""Scans that carry state across partitions: running and group values of ordered rows.

A window over a key puts all of the key's rows into one task. Here rows are
dealt into *blocks* instead: ranges of (key, order) from Spark's range
partitioner, so a hot key covers many blocks and no block holds more than its
share of rows. A running value is then the block's own window combined with the
value carried into the block. Only the first and the last key of a block can
lie in other blocks too, so what is carried is at most two rows a block: that
is the bound of the broadcasts below.

The block of each row is stored with it (``ordered``), as the bounds come from
a sample and must be the same for every read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import materialise

BLOCK = "_block"
_PLAIN = {"sum": F.sum, "min": F.min, "max": F.max}


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{c}_r"]) for c in columns])


def _renamed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_r" for c in columns})


def _over(kind: str, column: str, window) -> Column:
    value = F.last(column, ignorenulls=True) if kind == "last" else _PLAIN[kind](column)
    return value.over(window)


@dataclass
class Ordered:
    """Rows in blocks. ``keys`` ascend over the blocks; ``order`` are the columns
    (or sort expressions) that order the rows of a key, without ties that matter."""

    frame: DataFrame
    keys: list[str]
    order: list
    edges: DataFrame | None = None
    edge: DataFrame | None = None

    def _edges(self) -> DataFrame:
        """The first and the last key of each block, found once and stored: at most two rows a block."""
        if self.edges is None:
            key = F.struct(*self.keys)
            ends = self.frame.groupBy(BLOCK).agg(F.min(key).alias("a"), F.max(key).alias("b"))
            self.edges = materialise(ends.select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct(), "edges")
        return self.edges

    def _at_edges(self) -> DataFrame:
        """The rows of the edge keys. What is added to the frame is added to them too: windows are
        by block and key, so that what a call carries never needs the values of the other rows."""
        if not self.keys:
            return self.frame
        if self.edge is None:
            edges = _renamed(self._edges(), self.keys)
            self.edge = self.frame.join(F.broadcast(edges), _same(self.frame, edges, self.keys), "left_semi")
        return self.edge

    def _with(self, add) -> "Ordered":
        """The same rows with what ``add`` adds to a frame."""
        return Ordered(add(self.frame), self.keys, self.order, self.edges, add(self._at_edges()) if self.keys else None)

    def _plain_order(self) -> list[str]:
        if not all(isinstance(c, str) for c in self.order):
            raise ValueError("the last value needs an order of plain columns")
        return self.order

    def _total(self, kind: str, column: str) -> Column:
        if kind == "last":
            return F.max(F.when(F.col(column).isNotNull(), F.struct(*self._plain_order(), F.col(column).alias("_v"))))["_v"]
        return _PLAIN[kind](column)

    def running(self, **wanted: tuple[str, str]) -> "Ordered":
        """Adds name=(kind, column): the sum, min, max or last non-null value over the key's
        rows up to this one; kinds that end in ``_before`` stop at the row before. Null if
        there is none. All values of one call are taken from the columns as they were."""
        kinds = {n: k.removesuffix("_before") for n, (k, _) in wanted.items()}
        columns = [c for _, c in wanted.values()]
        if "last" in kinds.values():
            columns += [c for c in self._plain_order() if c not in self.keys]
        totals = self._at_edges().select(BLOCK, *self.keys, *dict.fromkeys(columns)).groupBy(BLOCK, *self.keys).agg(
            *[self._total(kinds[n], c).alias(n) for n, (_, c) in wanted.items()])
        earlier = Window.partitionBy(*self.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(BLOCK, *self.keys, *[_over(k, n, earlier).alias(f"{n}_c") for n, k in kinds.items()])
        carried = _renamed(carried, [BLOCK, *self.keys])
        own = Window.partitionBy(BLOCK, *self.keys).orderBy(*self.order)

        def here(name: str) -> Column:
            kind, column = wanted[name]
            end = -1 if kind.endswith("_before") else Window.currentRow
            return _over(kinds[name], column, own.rowsBetween(Window.unboundedPreceding, end))
        def combined(name: str) -> Column:
            inside, before = F.col(name), F.col(f"{name}_c")
            if kinds[name] == "sum":
                return F.when(inside.isNull(), before).otherwise(inside + F.coalesce(before, F.lit(0)))
            if kinds[name] == "last":
                return F.coalesce(inside, before)
            return (F.least if kinds[name] == "min" else F.greatest)(inside, before)

        def add(frame: DataFrame) -> DataFrame:
            local = frame.withColumns({n: here(n) for n in wanted})
            both = local.join(F.broadcast(carried), _same(local, carried, [BLOCK, *self.keys]), "left")
            return both.select(*[c for c in local.columns if c not in wanted], *[combined(n).alias(n) for n in wanted])
        return self._with(add)

    def total(self, **wanted: tuple[str, str]) -> "Ordered":
        """Adds name=(kind, column): the sum, min or max over all rows of the key."""
        if not self.keys:
            raise ValueError("the total of all rows is a plain aggregate")
        columns = dict.fromkeys(c for _, c in wanted.values())
        sums = self._at_edges().select(BLOCK, *self.keys, *columns).groupBy(*self.keys).agg(
            *[self._total(k, c).alias(f"{n}_c") for n, (k, c) in wanted.items()], F.lit(True).alias("_edge"))
        sums = _renamed(sums, self.keys)
        group = Window.partitionBy(BLOCK, *self.keys)

        def add(frame: DataFrame) -> DataFrame:
            local = frame.withColumns({n: _over(k, c, group) for n, (k, c) in wanted.items()})
            both = local.join(F.broadcast(sums), _same(local, sums, self.keys), "left")
            return both.select(*[c for c in local.columns if c not in wanted],
                               *[F.when(F.col("_edge"), F.col(f"{n}_c")).otherwise(F.col(n)).alias(n) for n in wanted])
        return self._with(add)

    def stored(self, name: str = "ordered") -> "Ordered":
        """The rows with their values written once, so that what follows does not compute them again."""
        return Ordered(materialise(self.frame, name), self.keys, self.order, self.edges)

    def with_columns(self, columns: dict[str, Column]) -> "Ordered":
        """The same rows with more columns, none of which is a key."""
        return self._with(lambda frame: frame.withColumns(columns))

    def within(self, column: str) -> "Ordered":
        """The same rows by (keys, column); the column must not fall along the order."""
        return Ordered(self.frame, [*self.keys, column], self.order)


def ordered(df: DataFrame, keys: list[str], order: list, name: str = "ordered", blocks: int | None = None) -> Ordered:
    """Deal the rows into blocks by (keys, order) and store them with their block.

    ``order`` should tell all rows of a key apart (end it with an id): rows that
    are equal in it cannot be split.
    """
    spark = df.sparkSession
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[F.col(k) for k in keys], *[F.col(c) if isinstance(c, str) else c for c in order])
    return Ordered(materialise(dealt.withColumn(BLOCK, F.spark_partition_id()), name), list(keys), list(order))
