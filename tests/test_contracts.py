"""Output contracts: column names and types of every report, and the key
audits of the test tables (SURVEY section 5.2, item 5)."""

import pytest
from conftest import sf_dir
from pyspark.sql import functions as F

import __spark_entry__ as entry
from velocart.operators import duplicate_keys
from velocart.sources.roles import SourceTables

NAMES = [("customer_id", "bigint"), ("first_name", "string"), ("last_name", "string")]
CONTRACTS = {
    "audit_duplicate_keys": [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("row_count", "bigint")],
    "r1_brand_volume": [("brand", "string")],
    "r2_daily_orders": [("order_date", "date"), ("orders_count", "bigint"), ("count_customers", "bigint")],
    "r3_titles": [("job_title", "string")],
    "r4a_not_exists": [("brand", "string")],
    "r4b_except": [("brand", "string")],
    "r5_top_customers": NAMES + [("count_order", "bigint")],
    "r6_lapsed": NAMES,
    "r7_top_product_buyers": NAMES,
    "r8_valuable": NAMES + [("industry", "string")],
    "scan_summary": [("table_name", "string"), ("row_count", "bigint"), ("column_count", "int")],
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_output_schema(spark, name):
    df = entry.queries()[name](spark, sf_dir("0.001"))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == CONTRACTS[name]


def test_keep_first_keeps_the_input_columns(spark):
    t = SourceTables(spark, sf_dir("0.001"))
    df = entry.queries()["keep_first"](spark, sf_dir("0.001"))
    assert df.schema == t.lineitem.schema


def test_audits_of_the_test_tables(spark):
    t = SourceTables(spark, sf_dir("0.01"))
    assert duplicate_keys(t.customer, "c_custkey").count() == 0
    assert duplicate_keys(t.orders, "o_orderkey").count() == 0
    assert duplicate_keys(t.part, "p_partkey").count() == 0
    lines = duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
    assert lines.count() == 11_785
    assert lines.agg(F.min("row_count")).first()[0] == 2
