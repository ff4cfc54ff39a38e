"""Time the oracle SQL of the headline queries in DuckDB (single node).

usage: python tools/duck_baseline.py [sf_dir] [threads]

A reference point only: the source publishes no timings, and its SQL runs
on a single-node database. Median of five runs after one warm-up; results
are fully materialised (fetchall).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from velocart.plans.oracle import SQL  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    threads = int(argv[2]) if len(argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"set threads = {threads}")
    for t in ("customer", "part", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name in HEADLINE:
        con.sql(SQL[name]).fetchall()
        times = []
        for _ in range(5):
            t0 = time.perf_counter()
            con.sql(SQL[name]).fetchall()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 4)
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": threads, "sf_dir": sf_dir,
                      "total": round(sum(out.values()), 4), "queries": out}))


if __name__ == "__main__":
    main(sys.argv)
