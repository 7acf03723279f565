"""Banding, SLA lookup and ranking helpers (built-in expressions and windows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import ordered


def band(value: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper bound (inclusive) the value does not exceed."""
    expr = None
    for bound, label in cuts:
        expr = F.when(value <= bound, label) if expr is None else expr.when(value <= bound, label)
    return expr.otherwise(otherwise)


def sla_limit(key: Column, limits: dict[str, int]) -> Column:
    """CASE key WHEN k THEN limit ... END; NULL for keys without a limit."""
    expr = None
    for k, v in limits.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds, from an ordered rule table."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(otherwise) if expr is None else expr.otherwise(otherwise)


def points(parts: list[tuple[Column, Column | int]]) -> Column:
    """Sum of the points of the conditions that hold (NULL counts as not)."""
    total = F.lit(0)
    for cond, n in parts:
        total = total + F.when(cond, n if isinstance(n, Column) else F.lit(n)).otherwise(F.lit(0))
    return total


def rank_within(df: DataFrame, partition: list[str], value: str, name: str, descending: bool = True) -> DataFrame:
    """RANK() OVER (PARTITION BY partition ORDER BY value), NULL values last.

    Rows are first reduced to counts per value (equal values have equal ranks);
    the values are then dealt into blocks by ranges of (partition, value) and the
    rows of earlier values counted by a scan over the blocks, so neither a hot
    partition nor a global rank lands in one task. Values are only compared, as
    the engine sorts them: NaN above infinity, -0.0 equal to 0.0. With an empty
    ``partition`` the rank is global.
    """
    keys = [f"_{p}" for p in partition]
    values = df.groupBy(*[F.col(p).alias(k) for p, k in zip(partition, keys)], F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    first = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_last()
    ranked = ordered(values, keys, [first], "rank").running(_before=("sum_before", "_n")).frame
    ranked = ranked.select(*keys, "_v", (F.coalesce("_before", F.lit(0)) + 1).cast("bigint").alias(name))
    match = F.col(value).eqNullSafe(F.col("_v"))
    for p, k in zip(partition, keys):
        match = match & F.col(p).eqNullSafe(F.col(k))
    return df.join(ranked, match).select(*[df[c] for c in df.columns], name)
