"""Key spines without joins.

``conformed_rollup`` replaces the warehouse pattern "aggregate each source,
UNION DISTINCT the keys into a spine, LEFT JOIN every source back and COALESCE
to zero" with one union of row-level projections and one aggregation: a single
shuffle (with map-side partial aggregation) instead of one per source plus one
per spine join, and each source is scanned once instead of twice.

Join semantics are kept exactly: a spine row whose *strict* key is NULL never
matches any source in the join form, so all its measures are zero there; the
same rows are zeroed here. Keys listed as ``null_safe`` match NULL to NULL
(``COALESCE(k, sentinel) = COALESCE(k, sentinel)`` in the join form).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Project a source onto the conformed layout; absent measures are NULL of their type,
    which a sum skips (adding a decimal zero for each row would cost as much as adding a value)."""
    present = set(df.columns)
    cols = [F.col(k) for k in keys]
    for name, zero in measures.items():
        cols.append(F.col(name) if name in present else F.when(F.lit(False), zero).alias(name))
    return df.select(*cols)


def conformed_rollup(branches: list[DataFrame], keys: list[str], measures: dict[str, Column],
                     strict_keys: list[str] | None = None) -> DataFrame:
    """Sum row-level measures of several sources over the union of their keys.

    ``measures`` maps name -> typed zero. Each branch carries the keys and the
    subset of measures it owns (row-level values or pre-aggregated ones).
    ``strict_keys`` (default: all keys) are the keys compared with ``=`` in the
    join form; rows with a NULL strict key keep their spine row but get zeros.
    """
    strict = keys if strict_keys is None else strict_keys
    unioned = reduce(DataFrame.unionByName, [align(b, keys, measures) for b in branches])
    summed = unioned.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    if strict:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in strict])
    else:
        null_key = F.lit(False)
    out = [F.col(k) for k in keys]
    for name, zero in measures.items():
        out.append(F.when(null_key, zero).otherwise(F.coalesce(F.col(name), zero)).alias(name))
    return summed.select(*out)


def sparse_rollup(branches: list[DataFrame], keys: list[str], measures: list[str]) -> DataFrame:
    """Union + aggregate where a measure absent from every row of a key stays NULL.

    The left-join-of-aggregates shape where a missing source means NULL (not 0).
    Returns the keys, the measures, and ``_src_<i>`` presence flags per branch.
    """
    parts = []
    for i, b in enumerate(branches):
        present = set(b.columns)
        cols = [F.col(k) for k in keys]
        for m in measures:
            cols.append(F.col(m) if m in present else F.lit(None).alias(m))
        for j in range(len(branches)):
            cols.append(F.lit(1 if i == j else 0).alias(f"_src_{j}"))
        parts.append(b.select(*cols))
    unioned = reduce(DataFrame.unionByName, parts)
    aggs = [F.sum(m).alias(m) for m in measures]
    aggs += [F.max(f"_src_{j}").alias(f"_src_{j}") for j in range(len(branches))]
    return unioned.groupBy(*keys).agg(*aggs)


def month_sequence(start, end) -> Column:
    """Array of month starts from ``start`` to ``end`` inclusive."""
    return F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))


def calendar(spark, start, end, name: str = "month") -> DataFrame:
    """One row per month start in [start, end] (GENERATE_DATE_ARRAY ... MONTH)."""
    return spark.range(1).select(F.explode(month_sequence(start, end)).alias(name))
