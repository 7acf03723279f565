"""As-of open backlog per period end, as a running sum of open/close events.

A record is open at the end of month ``m`` when it was opened on or before the
month end and is closed after it (or not closed). With month starts that is
``month(open) <= m < month(close)``, so each record contributes +1 at
``month(open)`` and -1 at ``month(close)`` (when it closes in a later month),
and the open count at ``m`` is the running sum of those deltas. The age of the
open set at the month end is ``open_count * day(month_end) - sum(day(open))``,
kept with a second running sum of +/- the open day number.

Cost is linear in the records (a fixed number of event rows each, reduced by a
map-side partial aggregation) plus a window over (key x month) totals. The
range-join form pairs every record with every month it stays open and
concentrates a hot key in one task; this form does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_of
from .spine import month_sequence

def _day_number(c: Column) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint")


def open_backlog_by_month(rows: DataFrame, keys: list[str], open_date: str, close_date: str,
                          first_month, last_month, flow_measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """Dense (keys x month) grid with flow measures and the month-end open backlog.

    ``flow_measures`` maps output name -> (month column, value column): a value
    counted in the month given by that column (e.g. new findings in the
    detection month, remediations in the patch month). Months outside
    [first_month, last_month] contribute flows to no row, while records opened
    before the window are carried into it. The key universe is every key
    combination present in ``rows`` (whatever its dates).
    Output: keys, month, each flow measure, ``open_count``, ``open_age_days``.
    """
    first = F.lit(first_month).cast("date")
    o_month = month_of(open_date)
    c_month = month_of(close_date)
    opens = F.col(open_date).isNotNull() & (F.col(close_date).isNull() | (c_month > o_month))
    closes = opens & F.col(close_date).isNotNull()
    day = _day_number(F.col(open_date))
    zero = F.lit(0).cast("bigint")
    names = list(flow_measures)

    def event(month: Column, flows: dict[str, Column], open_d: Column, age_d: Column) -> Column:
        fields = [month.alias("month")]
        fields += [flows.get(n, zero).cast("bigint").alias(n) for n in names]
        fields += [open_d.alias("open_d"), age_d.alias("age_d")]
        return F.struct(*fields)

    by_month: dict[str, dict[str, Column]] = {}
    for n, (mcol, value) in flow_measures.items():
        by_month.setdefault(mcol, {})[n] = value
    events = [event(F.col(mcol), flows, zero, zero) for mcol, flows in by_month.items()]
    events.append(F.when(opens, event(F.greatest(o_month, first), {}, F.lit(1).cast("bigint"), day)))
    events.append(F.when(closes, event(F.greatest(c_month, first), {}, F.lit(-1).cast("bigint"), -day)))

    exploded = rows.select(*keys, F.explode(F.array(*events)).alias("e")).filter(F.col("e").isNotNull())
    exploded = exploded.select(*keys, "e.*")
    measure_cols = names + ["open_d", "age_d"]
    # 1) records -> (key, month) totals: map-side partial aggregation, small shuffle.
    per_month = exploded.groupBy(*keys, "month").agg(*[F.sum(c).alias(c) for c in measure_cols])

    # 2) Densify without a second scan or a join: the first row of each key
    # (one shuffle on the key) also emits the key's zero-valued calendar rows.
    # The re-aggregation and the running-sum window below reuse that key
    # partitioning, so they add no shuffle.
    first_of_key = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("month").asc_nulls_first())) == 1
    tagged = per_month.withColumn("_first", first_of_key)
    own = F.array(F.struct(F.col("month").alias("month"), *[F.col(c).alias(c) for c in measure_cols]))
    calendar = F.transform(month_sequence(first_month, last_month),
                           lambda m: F.struct(m.alias("month"), *[zero.alias(c) for c in measure_cols]))
    rows_out = tagged.select(*keys, F.explode(F.when(F.col("_first"), F.concat(own, calendar)).otherwise(own))
                             .alias("e")).select(*keys, "e.*")
    last = F.lit(last_month).cast("date")
    rows_out = rows_out.filter(F.col("month").isNotNull() & (F.col("month") <= last))
    dense = rows_out.groupBy(*keys, "month").agg(*[F.sum(c).alias(c) for c in measure_cols])

    w = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_open = F.sum("open_d").over(w)
    run_age = F.sum("age_d").over(w)
    out = dense.select(*keys, "month", *names, run_open.alias("open_count"), run_age.alias("_age_sum"))
    out = out.filter(F.col("month") >= first)
    month_end_day = _day_number(F.last_day(F.col("month")))
    return out.select(*keys, "month", *names, "open_count",
                      (F.col("open_count") * month_end_day - F.col("_age_sum")).alias("open_age_days"))
