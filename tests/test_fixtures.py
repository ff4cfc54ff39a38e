"""Hand-made edge cases (FIXTURES.md section 3) run through the library."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from velocart.operators import duplicate_keys, keep_first
from velocart.plans import reports as R

D = dt.date.fromisoformat


def test_fx1_audit_counts_null_key_as_one_group(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,)], "id long")
    out = duplicate_keys(df, "id")
    assert out.columns == ["id", "row_count"]
    # ascending, NULL last (source dialect order)
    assert [tuple(r) for r in out.collect()] == [(1, 2), (None, 2)]


def test_fx2_keep_first_by_total_order(spark):
    df = spark.createDataFrame(
        [(1, "A", 2), (1, "B", 1), (2, "C", 9), (None, "D", 5), (None, "E", 4)],
        "id long, brand string, seq int",
    )
    out = keep_first(df, "id", ["seq"])
    assert out.columns == ["id", "brand", "seq"]
    assert rows(out, "id", "brand") == [(None, "E"), (1, "B"), (2, "C")]


def test_fx2_keep_first_file_order(spark, tmp_path):
    df = spark.createDataFrame([(1, "first"), (1, "second"), (2, "only")], "id long, v string").coalesce(1)
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    out = keep_first(spark.read.parquet(path), "id", "file_order")
    assert rows(out) == [(1, "first"), (2, "only")]


def product(spark, data):
    return spark.createDataFrame(
        data,
        "product_id long, brand string, product_line string, list_price decimal(12,2), standard_cost decimal(12,2)",
    )


def test_fx3_r1_same_product_meets_both(spark):
    p = product(
        spark,
        [
            (1, "A", None, None, Decimal("1600")),
            (2, "A", None, None, Decimal("1400")),
            (3, "B", None, None, Decimal("1501")),
            (4, "C", None, None, Decimal("1600")),
            (5, None, None, None, Decimal("2000")),
            (6, "D", None, None, Decimal("1500")),
        ],
    )
    items = spark.createDataFrame(
        [(1, 1000), (2, 5000), (3, 999), (5, 600), (5, 400), (6, 9000)], "product_id long, quantity int"
    )
    out = R.brands_by_cost_and_volume(p, items, 1500, 1000)
    assert rows(out) == [(None,), ("A",)]


def test_fx4_r2_daily_orders(spark):
    orders = spark.createDataFrame(
        [
            (1, D("2017-04-01"), 10, "Approved", True),
            (2, D("2017-04-01"), 10, "Approved", True),
            (3, D("2017-04-01"), None, "Approved", True),
            (4, D("2017-04-09"), 11, "Approved", True),
            (5, D("2017-04-10"), 12, "Approved", True),
            (6, D("2017-04-05"), 13, "Cancelled", True),
            (7, D("2017-04-05"), 14, "Approved", False),
            (8, D("2017-04-05"), 15, "Approved", None),
            (9, D("2017-03-31"), 16, "Approved", True),
        ],
        "order_id long, order_date date, customer_id long, order_status string, online_order boolean",
    )
    out = R.daily_orders(orders)
    assert [tuple(r) for r in out.collect()] == [(D("2017-04-01"), 3, 1), (D("2017-04-09"), 1, 1)]


FX5 = [
    ("Senior Dev", "IT", "1988-02-28"),
    ("senior dev", "IT", "1980-05-05"),
    ("Senior Dev", "IT", "1970-01-01"),
    ("Senior QA", "IT", "1989-03-01"),
    ("Senior Ops", "IT", "1988-02-29"),
    ("Lead Analyst", "Financial Services", "1975-01-01"),
    ("Lead Analyst", "IT", "1975-01-01"),
    ("Senior Banker", "Financial Services", "1970-01-01"),
    ("Leading Hand", "Financial Services", "1960-01-01"),
    ("Senior Null", "IT", None),
    (None, "IT", "1960-01-01"),
]


def test_fx5_r3_titles_completed_years(spark):
    c = spark.createDataFrame(FX5, "job_title string, job_industry_category string, dob string")
    out35 = R.titles_by_rules(c, min_age=35, as_of="2025-02-28")
    assert sorted(r[0] for r in out35.collect()) == sorted(
        ["Senior Dev", "senior dev", "Senior Ops", "Lead Analyst", "Leading Hand"]
    )
    out36 = R.titles_by_rules(c, min_age=36, as_of="2025-02-28")
    # born 29 Feb: 36 completed years on 28 Feb 2025 only if months are
    # counted month-end to month-end; completed years says 36 is not > 36
    assert sorted(r[0] for r in out36.collect()) == sorted(["Senior Dev", "senior dev", "Lead Analyst", "Leading Hand"])


def test_fx5_union_all_keeps_cross_branch_duplicates(spark):
    c = spark.createDataFrame(
        [("Lead X", "IT", "1960-01-01"), ("Lead X", "FS", "1960-01-01")],
        "job_title string, job_industry_category string, dob string",
    )
    out = R.titles_by_rules(c, rules=(("IT", "lead%"), ("FS", "lead%")), min_age=35, as_of="2025-01-01")
    assert [r[0] for r in out.collect()] == ["Lead X", "Lead X"]


def r4_inputs(spark):
    pairs = [("A", "FS"), ("B", "FS"), (None, "FS"), ("B", "IT"), (None, "IT"), ("A", "Retail"), ("C", "IT"), ("A", None)]
    customer = spark.createDataFrame(
        [(i, ind) for i, (_, ind) in enumerate(pairs)], "customer_id long, job_industry_category string"
    )
    orders = spark.createDataFrame([(i, i) for i in range(len(pairs))], "order_id long, customer_id long")
    brands = sorted({b for b, _ in pairs if b is not None})
    product = spark.createDataFrame([(j, b) for j, b in enumerate(brands)], "product_id long, brand string")
    pid = {b: j for j, b in enumerate(brands)}
    # a NULL brand is an order without any line
    items = spark.createDataFrame(
        [(i, pid[b]) for i, (b, _) in enumerate(pairs) if b is not None], "order_id long, product_id long"
    )
    return orders, items, product, customer


def test_fx6_r4_not_exists_vs_except(spark):
    o, i, p, c = r4_inputs(spark)
    keep = R.bought_by_a_not_b(o, i, p, c, "FS", "IT", null_brand="keep")
    match = R.bought_by_a_not_b(o, i, p, c, "FS", "IT", null_brand="match")
    assert rows(keep) == [(None,), ("A",)]
    assert rows(match) == [("A",)]


def test_fx7_r5_mean_before_deceased_filter(spark):
    customer = spark.createDataFrame(
        [
            (1, "NSW", 12, "N"),
            (2, "NSW", 4, "N"),
            (3, "NSW", 20, "Y"),
            (8, "NSW", 9, "N"),
            (7, "NSW", None, "N"),
            (4, None, 8, "N"),
            (5, None, 2, "N"),
            (6, "VIC", 5, "N"),
        ],
        "customer_id long, state string, property_valuation int, deceased_indicator string",
    ).withColumn("first_name", F.concat(F.lit("f"), F.col("customer_id").cast("string"))).withColumn(
        "last_name", F.lit("x")
    )
    orders = spark.createDataFrame(
        [(1, 1, True), (2, 1, True), (3, 1, False), (4, 4, True), (5, 4, None), (6, 4, True), (7, 8, True), (8, 1, True)],
        "order_id long, customer_id long, online_order boolean",
    )
    product = spark.createDataFrame(
        [(1, "Giant Bicycles"), (2, "Norco Bicycles"), (3, "Solex")], "product_id long, brand string"
    )
    items = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 2), (3, 1), (4, 3), (5, 1), (6, 1), (7, 1)], "order_id long, product_id long"
    )
    out = R.top_customers(customer, orders, items, product)
    assert [(r.customer_id, r.count_order) for r in out.collect()] == [(1, 2), (4, 1)]


def test_fx8_r6_lapsed(spark):
    customer = spark.createDataFrame(
        [
            (1, "Yes", "High Net Worth"),
            (2, "Yes", "High Net Worth"),
            (3, "Yes", "Affluent Customer"),
            (4, "Yes", "High Net Worth"),
            (5, "No", "High Net Worth"),
            (6, "Yes", "Mass Customer"),
            (7, "Yes", None),
            (8, "Yes", "Affluent Customer"),
            (9, "Yes", "High Net Worth"),
        ],
        "customer_id long, owns_car string, wealth_segment string",
    ).select("*", F.lit("f").alias("first_name"), F.lit("l").alias("last_name"))
    orders = spark.createDataFrame(
        [
            (1, D("2018-01-03"), "Approved", True),
            (2, D("2017-12-31"), "Approved", True),
            (3, D("2018-01-02"), "Approved", False),
            (4, D("2018-01-02"), "Approved", None),
            (9, D("2018-01-05"), "Cancelled", True),
            (None, D("2018-01-04"), "Approved", True),
        ],
        "customer_id long, order_date date, order_status string, online_order boolean",
    )
    out = R.lapsed_customers(customer, orders)
    assert sorted(r.customer_id for r in out.collect()) == [2, 3, 4, 8, 9]


def test_fx9_r7_null_price_ranks_first(spark):
    product = spark.createDataFrame(
        [(1, "Road", None), (2, "Road", 100), (3, "Road", 90), (4, "Road", 80), (5, "Road", 70), (6, "Road", 60), (7, "Mountain", 999)],
        "product_id long, product_line string, list_price int",
    )
    purchases = [(1, "IT", 1, 1), (1, "IT", 1, 2), (2, "IT", 2, 2), (2, "IT", 3, 2), (3, "IT", 4, 5), (3, "IT", 4, 6), (4, "Health", 5, 2), (4, "Health", 5, 3)]
    customer = spark.createDataFrame(
        sorted({(c, ind, "f", "l") for c, ind, _, _ in purchases}),
        "customer_id long, job_industry_category string, first_name string, last_name string",
    )
    orders = spark.createDataFrame(sorted({(o, c) for c, _, o, _ in purchases}), "order_id long, customer_id long")
    items = spark.createDataFrame([(o, p) for _, _, o, p in purchases], "order_id long, product_id long")
    out = R.buyers_of_top_products(customer, orders, items, product)
    assert [r.customer_id for r in out.collect()] == [1]


def test_fx10_r8_revenue_and_open_end(spark):
    customer = spark.createDataFrame(
        [(1, "IT"), (2, "IT"), (3, "Health"), (4, "Health"), (5, "Health"), (6, "Retail"), (7, "IT")],
        "customer_id long, job_industry_category string",
    ).select("*", F.lit("f").alias("first_name"), F.lit("l").alias("last_name"))
    spec = {
        1: [(1, "2017-01-02", "4000.00", 1), (2, "2017-01-03", "2000.00", 2), (3, "2017-01-04", "2000.00", 1)],
        2: [(4, "2017-01-02", "4000.00", 1), (5, "2017-01-03", "2000.00", 2), (6, "2017-01-04", "2000.01", 1)],
        3: [(7, "2017-01-02", "25000.00", 1), (8, "2017-01-03", "25000.00", 1)],
        4: [(9, "2017-01-02", "9000.00", 1), (10, "2017-01-03", "9000.00", 1), (11, "2017-03-01", "9000.00", 1)],
        5: [(12, "2017-01-01", "4000.00", 1), (13, "2017-02-01", "4000.00", 1), (14, "2017-02-28", "2000.00", 2)],
        6: [(15, "2017-01-02", "9000.00", 1), (16, "2017-01-03", "9000.00", 1), (17, "2017-01-04", "9000.00", 1)],
        7: [(18, "2017-01-02", "9000.00", 1), (19, "2017-01-03", "9000.00", 1), (20, "2017-01-04", None, None)],
    }
    orders = spark.createDataFrame(
        [(o, c, D(d), "Approved") for c, lines in spec.items() for o, d, _, _ in lines],
        "order_id long, customer_id long, order_date date, order_status string",
    )
    items = spark.createDataFrame(
        [(o, Decimal(p), q) for lines in spec.values() for o, _, p, q in lines if p is not None],
        "order_id long, item_list_price_at_sale decimal(12,2), quantity int",
    )
    out = R.valuable_customers(customer, orders, items)
    assert [(r.customer_id, r.industry) for r in out.collect()] == [(5, "Health"), (2, "IT")]
