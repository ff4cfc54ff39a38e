"""Write an N-times larger copy of the test tables, for scaling checks.

usage: python tools/scale_copy.py SRC_DIR DST_DIR N [FILES]

Copy i (0..N-1) shifts every key by i times the table's key range, so the
copies are disjoint and every join stays as selective as in the source.
Each table is written as FILES Parquet files (default 16), so scans run as
many tasks, as on a cluster. All work is a Spark job; nothing is collected.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from velocart.session import build_session  # noqa: E402

# key columns per table, and which key range each one belongs to
KEYS = {
    "customer": {"c_custkey": "customer"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "part": {"p_partkey": "part"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part"},
}
RANGE_OF = {"customer": ("customer", "c_custkey"), "orders": ("orders", "o_orderkey"), "part": ("part", "p_partkey")}


def main(argv):
    src, dst, n = argv[1], argv[2], int(argv[3])
    files = int(argv[4]) if len(argv) > 4 else 16
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    span = {}
    for name, (table, col) in RANGE_OF.items():
        span[name] = spark.read.parquet(f"{src}/{table}.parquet").agg(F.max(col)).first()[0] + 1
    for table, keys in KEYS.items():
        replicate = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
        df = spark.read.parquet(f"{src}/{table}.parquet").withColumn("copy", replicate)
        for col, rng in keys.items():
            df = df.withColumn(col, (F.col(col) + F.col("copy") * F.lit(span[rng])).cast("bigint"))
        df.drop("copy").repartition(files).write.mode("errorifexists").parquet(f"{dst}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
