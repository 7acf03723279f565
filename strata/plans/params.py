"""Run parameters shared by the jobs.

Jobs never read the wall clock: ``as_of`` is an explicit argument. The IT
month spine is the 36 months that end with the month before ``as_of``.
"""

from __future__ import annotations

import datetime as dt

# The warehouse anchor date and the IT spine length.
DEFAULT_AS_OF = dt.date(2026, 6, 4)
SPINE_MONTHS = 36


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1) if d.day == 1 else d.replace(year=d.year + y, month=m + 1)


def it_spine(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """(first, last) month start of the IT reporting spine for ``as_of``."""
    last = add_months(month_start(as_of), -1)
    first = add_months(last, -(SPINE_MONTHS - 1))
    return first, last
