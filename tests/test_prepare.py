"""Audit -> keep first -> stored table, and the bucketed fact layout."""

import datetime as dt
import os
import subprocess
import sys

from conftest import ROOT, rows, sf_dir
from pyspark.sql import functions as F

from velocart.plans import prepare
from velocart.plans import reports as R
from velocart.plans.registry import QUERIES
from velocart.sources import create_namespace, roles, table_path
from velocart.sources.roles import TEST_SCHEMAS, SourceTables


def test_audit_and_store_first_per_key(spark):
    t = SourceTables(spark, sf_dir("0.001"))
    frames = {
        "customer": t.customer.withColumnRenamed("c_custkey", "customer_id"),
        "orders": t.orders.withColumnRenamed("o_orderkey", "order_id"),
        "product": t.part.withColumnRenamed("p_partkey", "product_id"),
    }
    audits = prepare.audit_tables(frames)
    assert {k: v.count() for k, v in audits.items()} == {"customer": 0, "orders": 0, "product": 0}

    create_namespace(spark, "prep")
    lines = t.lineitem
    stored = prepare.store_first_per_key(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], "prep.lineitem_first",
        mode="overwrite",
    )
    assert stored.count() == 4599
    assert prepare.audit_tables({"x": stored}, {"x": ["l_orderkey", "l_linenumber"]})["x"].count() == 0


def test_prepare_shop_stores_and_reads_back(spark):
    rows = [(1, "A", "Road", 1.0, 2.0, 2), (1, "B", "Road", 3.0, 4.0, 1), (2, "C", None, None, None, 1)]
    product = spark.createDataFrame(rows, "product_id long, brand string, product_line string, list_price double, standard_cost double, import_no int")
    frames = {"product": product, "customer": None, "orders": None, "order_items": None}
    shop = prepare.prepare_shop(frames, "prep_shop", "first_products", "import_no", mode="overwrite")
    assert sorted((r.product_id, r.brand) for r in shop["product"].collect()) == [(1, "B"), (2, "C")]
    assert "import_no" not in shop["product"].columns and set(shop) == set(frames)
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="already exists"):
        prepare.prepare_shop(frames, "prep_shop", "first_products", "import_no")


ANOTHER_SESSION = """
import sys
from velocart.plans.registry import QUERIES
from velocart.session import build_session

name, root, out, warehouse, scratch = sys.argv[1:]
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.sql.warehouse.dir": warehouse, "spark.local.dir": scratch})
QUERIES[name](spark, root).write.parquet(out)
spark.stop()
"""


def from_another_session(spark, tmp_path, name, root):
    """Result of a query in a process whose catalog knows no table of this session, over this session's warehouse."""
    out, warehouse = str(tmp_path / "out"), spark.conf.get("spark.sql.warehouse.dir")
    done = subprocess.run(
        [sys.executable, "-c", ANOTHER_SESSION, name, root, out, warehouse, str(tmp_path / "scratch")],
        cwd=tmp_path, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return spark.read.parquet(out)


def write_tables(spark, root, **tables):
    for name, schema in TEST_SCHEMAS.items():
        spark.createDataFrame(tables.get(name, []), schema).coalesce(1).write.parquet(table_path(str(root), name))
    return str(root)


def test_sessions_over_one_warehouse_store_products_side_by_side(spark, tmp_path):
    part = [(1, "n", "A", "ECONOMY", 1, 10.0), (2, "n", None, None, None, None), (3, "n", "C", "ECONOMY", 1, 30.0)]
    root = write_tables(spark, tmp_path / "tables", part=part)
    expected = [(1, "A", "ECONOMY", 10.0, 10.0), (2, None, None, None, None), (3, "C", "ECONOMY", 30.0, 30.0)]
    here = QUERIES["stored_product_new"](spark, root)
    assert rows(from_another_session(spark, tmp_path, "stored_product_new", root)) == expected
    assert rows(here) == expected  # the other session left this one's table alone


def test_r7_over_stored_products_whatever_else_stored_them(spark, tmp_path):
    """40 parts, the dearer the higher the key: the 20 dearest are 21 to 40; by the second imports 15 and 18 would be among them."""
    day = dt.datetime(1997, 1, 1)
    part = [(k, "n", "A", "ECONOMY", 1, float(k)) for k in range(1, 41)]
    customer = [(1, "Ann#1", 1, 0.0, "BUILDING"), (2, "Bo#2", 1, 0.0, "MACHINERY"), (3, "Cy#3", 1, 0.0, "HOUSEHOLD"), (4, "Di#4", 1, 0.0, "MACHINERY")]
    bought = {1: (39, 40), 2: (20, 21, None), 3: (39, 40), 4: (15, 18)}
    orders = [(10 * c, c, "F", 1.0, day, "2-HIGH") for c in bought]
    lineitem = [(10 * c, p, 1, n, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for c, ps in bought.items() for n, p in enumerate(ps)]
    root = write_tables(spark, tmp_path / "tables", part=part, customer=customer, orders=orders, lineitem=lineitem)
    first = QUERIES["r7_stored_product"](spark, root)
    for name in ("stored_product_new", "r1_stored_product"):
        QUERIES[name](spark, root)
    assert rows(from_another_session(spark, tmp_path, "r7_stored_product", root)) == [(1, "Ann", "1")]
    assert rows(first) == [(1, "Ann", "1")]


def test_bucketed_facts_join_without_exchange(spark):
    t = SourceTables(spark, sf_dir("0.01"))
    create_namespace(spark, "prep")
    orders, items = prepare.store_facts_bucketed(
        roles.orders_role(t.orders), roles.order_items_role(t.lineitem), 8, "prep.orders_b", "prep.items_b",
        mode="overwrite",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = orders.join(items, "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan
        # R4 on the bucketed copies: no exchange below the first aggregate on the line side
        r4 = R.bought_by_a_not_b(orders, items, roles.product_role(t.part), roles.customer_industry_role(t.customer), "BUILDING", "MACHINERY")
        lines = r4._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, x in enumerate(lines) if "items_b" in x and "Scan" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        above, at = [], depth(lines[scan])
        for x in reversed(lines[:scan]):
            if depth(x) < at:
                at = depth(x)
                above.append(x)
        first_join = next(i for i, x in enumerate(above) if "SortMergeJoin" in x)
        assert not any("Exchange" in x for x in above[:first_join])
        # and the reports give the same answer on the bucketed copies
        c = roles.customer_industry_role(t.customer)
        kw = dict(industries=("BUILDING", "HOUSEHOLD"), status="F", start="1996-01-01", end="1998-01-01",
                  min_orders=3, min_revenue=15_000_000)
        assert R.valuable_customers(c, orders, items, **kw).count() == 38
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_partitioned_orders_prune_partitions(spark):
    from velocart.sources import save_table

    t = SourceTables(spark, sf_dir("0.01"))
    create_namespace(spark, "prep")
    # one year of orders keeps the fixture to a few hundred date folders
    flat = roles.orders_role(t.orders).filter(F.year("order_date") == 1997)
    save_table(flat, "prep.orders_by_day", mode="overwrite", partition_by=["order_date"])
    orders = spark.table("prep.orders_by_day")
    r2 = R.daily_orders(orders, "1997-04-01", "1997-04-09", status="F")
    plan = r2._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "(order_date#" in plan
    assert sorted(r2.collect()) == sorted(R.daily_orders(flat, "1997-04-01", "1997-04-09", status="F").collect())
    # the latest-year range of R6 prunes too, with the year from its scalar sub-query
    c = roles.customer_car_role(t.customer)
    r6 = R.lapsed_customers(c, orders, status="F", excluded_segment="AUTOMOBILE")
    plan6 = r6._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan6 and "make_date(Subquery" in plan6
    assert sorted(r6.collect()) == sorted(R.lapsed_customers(c, flat, status="F", excluded_segment="AUTOMOBILE").collect())


def test_analyze_tables_gives_row_counts(spark):
    from velocart.sources import save_table

    t = SourceTables(spark, sf_dir("0.001"))
    create_namespace(spark, "prep")
    save_table(roles.orders_role(t.orders), "prep.orders_stats", mode="overwrite")
    prepare.analyze_tables(spark, ["prep.orders_stats"])
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED prep.orders_stats").collect()}
    assert "1500 rows" in described["Statistics"]
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        table_rows = spark.table("prep.orders_stats")._jdf.queryExecution().optimizedPlan().stats().rowCount()
        assert int(str(table_rows.get())) == 1500
        filtered = spark.table("prep.orders_stats").filter(F.col("order_status") == "F")
        est = filtered._jdf.queryExecution().optimizedPlan().stats().rowCount()
        assert est.isDefined() and int(str(est.get())) < 1500
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
