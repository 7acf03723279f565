"""Column helpers for the warehouse dialect semantics the metric jobs rely on.

All helpers return built-in Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

import calendar
import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money columns of the raw layer are decimal(18,2); measures cast to NUMERIC
# keep NUMERIC's nine fractional digits without widening to 38 digits, so a
# product of two of them stays exact (decimal(18,9) * decimal(18,2) -> (37,11)).
MONEY = DecimalType(18, 2)
NUMERIC = DecimalType(18, 9)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(F.to_date(col(c)), "MM")


def day_of(c) -> Column:
    return F.to_date(col(c))


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def as_numeric(c) -> Column:
    """CAST(float AS NUMERIC): round half away from zero to 9 digits."""
    return col(c).cast(NUMERIC)


def flag(cond: Column) -> Column:
    """1 where the predicate is TRUE, else 0 (NULL counts as not true)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_where(cond: Column) -> Column:
    """COUNTIF: rows whose predicate is TRUE; 0 when none."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_where(cond: Column, value, zero: Column | None = None) -> Column:
    """SUM(IF(cond, value, zero))."""
    z = F.lit(0) if zero is None else zero
    return F.sum(F.when(cond, col(value)).otherwise(z))


def exact_sum(value) -> Column:
    """SUM of a floating column, added as decimals and given back as DOUBLE.

    The result does not depend on the order in which tasks finish.
    """
    return F.sum(as_numeric(value)).cast("double")


def exact_sum_where(cond: Column, value) -> Column:
    """SUM(IF(cond, value, 0)) of a floating column, added as decimals."""
    return F.sum(F.when(cond, as_numeric(value)).otherwise(F.lit(0).cast(NUMERIC))).cast("double")


def safe_ratio(num, den) -> Column:
    """SAFE_DIVIDE as a DOUBLE: NULL when the divisor is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def strict_least(*cols) -> Column:
    """LEAST that is NULL when any argument is NULL (Spark's skips NULLs)."""
    cs = [col(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def days_between(later, earlier) -> Column:
    """DATE_DIFF(later, earlier, DAY): signed day count."""
    return F.datediff(col(later), col(earlier))


def month_boundaries(later, earlier) -> Column:
    """DATE_DIFF(later, earlier, MONTH): month boundaries crossed (not whole months)."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def whole_units(unit: str, start, end) -> Column:
    """TIMESTAMP_DIFF(end, start, unit): whole elapsed units, truncated."""
    return F.timestamp_diff(unit, col(start), col(end))


def days_in_month(month) -> Column:
    return F.dayofmonth(F.last_day(col(month)))


def as_of_lit(as_of) -> Column:
    return F.lit(as_of).cast("date")


def _shift_months(d: _dt.date, n: int) -> _dt.date:
    """ADD_MONTHS on a Python date (day clamped to the month's last day)."""
    y, m = divmod(d.month - 1 + n, 12)
    y, m = d.year + y, m + 1
    return _dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def ttm_window(date_col, as_of, months: int = 12, bounded: bool = False) -> Column:
    """Trailing window on DATE(col): > as_of - months (exclusive), optionally <= as_of.

    Written against the raw column with literal day boundaries
    (``col >= lower + 1 day`` and ``col < as_of + 1 day``), which is the same
    predicate for DATE and TIMESTAMP columns but, unlike ``to_date(col) > x``,
    is pushed down to the parquet scan and prunes row groups.
    """
    a = _dt.date.fromisoformat(str(as_of)) if not isinstance(as_of, _dt.date) else as_of
    start = _shift_months(a, -months) + _dt.timedelta(days=1)
    c = col(date_col)
    cond = c >= F.lit(start)
    if bounded:
        cond = cond & (c < F.lit(a + _dt.timedelta(days=1)))
    return cond
