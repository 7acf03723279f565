"""Duplicate detection operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_line_counts(df: DataFrame, key_cols: list[str], by_cols: list, name: str = "n") -> DataFrame:
    """Lines per (key, by) for keys that occur more than once overall.

    Equivalent to counting the rows of ``COUNT(*) OVER (PARTITION BY key) > 1``
    grouped by ``by``, but skew-proof: rows are first reduced to (key, by)
    counts with a map-side partial aggregation, and the per-key total is a
    window over those few rows per key (one per distinct ``by`` value), so a
    key holding a large share of all rows never lands whole in one task.
    """
    per = df.groupBy(*key_cols, *by_cols).agg(F.count(F.lit(1)).alias(name))
    total = F.sum(name).over(Window.partitionBy(*key_cols))
    return per.withColumn("_total", total).filter(F.col("_total") > 1).drop("_total")
