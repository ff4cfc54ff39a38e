"""Command-line runner: ``python -m velocart`` (or via spark-submit).

    python -m velocart list
    python -m velocart run r5_top_customers --tables /data/sf0.01 [--out /shared/out/r5] [--show 20]
    python -m velocart run-all --tables /data/sf0.01 --out /shared/out [--queries r1_brand_volume,r8_valuable]

``run`` builds the registered query over the Parquet tables in ``--tables``
and either writes it (Parquet, fails if the target exists unless
``--overwrite``) or prints the first rows. ``run-all`` writes every chosen
query (default: all registered) to ``<out>/<query>``, one Spark job after
the other. On a cluster, master and resources come from spark-submit.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="velocart")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("query")
    run.add_argument("--tables", required=True, help="folder with <table>.parquet datasets")
    run.add_argument("--out", help="write the result here as Parquet")
    run.add_argument("--overwrite", action="store_true")
    run.add_argument("--show", type=int, default=20, help="rows to print when --out is not given")
    run.add_argument("--master", help="Spark master (default: from spark-submit)")
    run_all = sub.add_parser("run-all", help="write several registered queries as Parquet")
    run_all.add_argument("--tables", required=True, help="folder with <table>.parquet datasets")
    run_all.add_argument("--out", required=True, help="output folder; one sub-folder per query")
    run_all.add_argument("--queries", help="comma-separated query names (default: all)")
    run_all.add_argument("--overwrite", action="store_true")
    run_all.add_argument("--master", help="Spark master (default: from spark-submit)")
    args = parser.parse_args(argv)

    from velocart.plans.registry import QUERIES

    if args.cmd == "list":
        for name in QUERIES:
            print(name)
        return 0
    names = [args.query] if args.cmd == "run" else (args.queries.split(",") if args.queries else list(QUERIES))
    unknown = [n for n in names if n not in QUERIES]
    if unknown:
        parser.error(f"unknown query {unknown[0]!r}; see 'list'")

    from pyspark.sql import SparkSession

    from velocart.session import build_session

    owned = SparkSession.getActiveSession() is None
    spark = build_session(args.master, app_name=f"velocart-{args.cmd}")
    mode = "overwrite" if args.overwrite else "errorifexists"
    if args.cmd == "run":
        df = QUERIES[args.query](spark, args.tables)
        if args.out:
            df.write.mode(mode).parquet(args.out)
        else:
            df.show(args.show, truncate=False)
    else:
        for name in names:
            QUERIES[name](spark, args.tables).write.mode(mode).parquet(f"{args.out.rstrip('/')}/{name}")
            print(f"wrote {name}")
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
