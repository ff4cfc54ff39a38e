"""Same rows whatever the partitioning: what a recomputed task (after a lost
executor) relies on. Keep-first and top-k orders are total, so the chosen
rows cannot depend on which task sees which rows first."""

import pytest
from conftest import sf_dir

import __spark_entry__ as entry

CASES = ["keep_first", "r5_top_customers", "r7_top_product_buyers", "topk_by_aggregate", "topk_by_column"]


@pytest.mark.parametrize("name", CASES)
def test_same_rows_under_different_partitioning(spark, name):
    results = []
    for partitions, max_split in (("3", "64k"), ("17", "128m")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.files.maxPartitionBytes", max_split)
        try:
            df = entry.queries()[name](spark, sf_dir("0.01"))
            results.append(sorted(tuple(r) for r in df.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert results[0] == results[1]
