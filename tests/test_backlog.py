"""Running-sum backlog equals the brute-force month-end range condition."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.backlog import open_backlog_by_month

D = dt.date
FIRST, LAST = D(2001, 1, 1), D(2001, 6, 1)

# key, opened, closed: closed at a month end, closed before opened, no open
# date, opened before the window, closed after the window, never closed,
# closed in the opening month, two keys.
ROWS = [
    ("a", D(2001, 1, 10), D(2001, 1, 31)),
    ("a", D(2001, 3, 5), D(2001, 2, 1)),
    ("a", None, D(2001, 3, 1)),
    ("a", D(2000, 11, 2), D(2001, 2, 15)),
    ("a", D(2001, 5, 20), D(2001, 9, 1)),
    ("b", D(2000, 12, 31), None),
    ("b", D(2001, 4, 2), D(2001, 4, 30)),
    ("b", D(2001, 6, 30), None),
]


def _month_end(m):
    nxt = D(m.year + (m.month == 12), m.month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def _months():
    m = FIRST
    while m <= LAST:
        yield m
        m = D(m.year + (m.month == 12), m.month % 12 + 1, 1)


def brute():
    out = {}
    for key in {"a", "b"}:
        for m in _months():
            me = _month_end(m)
            open_rows = [o for k, o, c in ROWS if k == key and o is not None and o <= me and (c is None or c > me)]
            new = sum(1 for k, o, c in ROWS if k == key and o is not None and D(o.year, o.month, 1) == m)
            out[(key, m)] = (len(open_rows), sum((me - o).days for o in open_rows), new)
    return out


def test_backlog_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, "k string, opened date, closed date").withColumn(
        "o_month", F.trunc("opened", "MM"))
    got = open_backlog_by_month(df, ["k"], "opened", "closed", FIRST, LAST,
                                {"new": ("o_month", F.lit(1))}).collect()
    res = {(r.k, r.month): (r.open_count, r.open_age_days, r.new) for r in got}
    assert res == brute()
