"""Batch pipeline: build every metric table in dependency order.

    python -m strata.pipeline --raw <parquet base> --out <metrics base> [--as-of YYYY-MM-DD]
    python -m strata.pipeline --testdata /root/testdata/sf0.01 --out <metrics base>

Each table is written with full overwrite in its warehouse layout (partition
and cluster columns from ``plans.layer.LAYOUT``); dependents (the executive
scorecards, the rationalisation worklist) read the written tables, so a lost
executor only recomputes the current table's stages. The output location
defaults to ``<spark.checkpoint.dir>/metrics``, the shared folder the
cluster names.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import time

from .plans.layer import BUILD_ORDER, DERIVED_JOBS, MetricLayer
from .plans.params import DEFAULT_AS_OF
from .session import build_session, warehouse_path
from .sources import RawTables
from .sources.testdata import BINDING_AS_OF


def run(spark, raw: RawTables, out_dir: str, as_of=DEFAULT_AS_OF, tables=None) -> dict[str, float]:
    layer = MetricLayer(raw, as_of, store=out_dir)
    wanted = set(tables or BUILD_ORDER)
    for name in list(wanted):
        wanted.update(DERIVED_JOBS.get(name, ()))
    timings = {}
    for name in sorted(wanted, key=lambda n: (n in DERIVED_JOBS, BUILD_ORDER.index(n))):
        t0 = time.perf_counter()
        layer.build(name)
        timings[name] = round(time.perf_counter() - t0, 3)
    return timings


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="base folder of raw parquet tables")
    src.add_argument("--testdata", help="driver test-table folder (bound to raw tables)")
    ap.add_argument("--out", help="output base folder (default: <spark.checkpoint.dir>/metrics)")
    ap.add_argument("--as-of", help="anchor date YYYY-MM-DD")
    ap.add_argument("--master", default=None)
    ap.add_argument("--namespace", help="also register the written tables as <namespace>.<table>")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.testdata:
        raw, as_of = RawTables.testdata(spark, args.testdata), BINDING_AS_OF
    else:
        raw, as_of = RawTables.parquet(spark, args.raw), DEFAULT_AS_OF
    if args.as_of:
        as_of = dt.date.fromisoformat(args.as_of)
    out = args.out or warehouse_path(spark, "metrics")
    for name, secs in run(spark, raw, out, as_of).items():
        print(f"{name:40s} {secs:8.2f}s  {os.path.join(out, name)}")
    if args.namespace:
        MetricLayer(raw, as_of, store=out).register(args.namespace)


if __name__ == "__main__":
    main()
