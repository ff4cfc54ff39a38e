"""Registered queries: each binds the test tables to roles and runs one
report or operator. Parameters are those recorded in FIXTURES.md."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velocart import functions as fx
from velocart import operators as op
from velocart.operators import quality
from velocart.plans import prepare
from velocart.plans import reports as R
from velocart.sources import roles, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Fixed size of the nation dimension, at every scale of the test data.
NATIONS = 25


def register(name: str):
    def deco(fn: Callable[[roles.SourceTables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(roles.SourceTables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return deco


# ---- composites ------------------------------------------------------------
@register("audit_duplicate_keys")
def _audit(t):
    """Duplicate-key audit of lineitem on (l_orderkey, l_linenumber)."""
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register("audit_customer_keys")
def _audit_customer(t):
    """Duplicate-key audit of the customer table (no duplicates expected)."""
    return quality.duplicate_keys(t.customer, "c_custkey")


@register("audit_orders_keys")
def _audit_orders(t):
    """Duplicate-key audit of the orders table (no duplicates expected)."""
    return quality.duplicate_keys(t.orders, "o_orderkey")


@register("audit_part_keys")
def _audit_part(t):
    """Duplicate-key audit of the part (product) table (no duplicates expected)."""
    return quality.duplicate_keys(t.part, "p_partkey")


@register("keep_first")
def _keep_first(t):
    """One line per (l_orderkey, l_linenumber): earliest ship date, then part, supplier."""
    return quality.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@register("keep_first_file_order")
def _keep_first_file_order(t):
    """One line per (l_orderkey, l_linenumber): the first as imported, in the order of the files."""
    return quality.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], quality.FILE_ORDER)


def _imported_products(t):
    """Products with duplicates, in import order (``import_no``): every third product comes a second time, under
    another brand and three times the price."""
    product = roles.product_role(t.part)
    first = product.withColumn("import_no", F.lit(1))
    second = product.filter(F.col("product_id") % 3 == 0).withColumns(
        {
            "brand": F.concat(F.col("brand"), F.lit(" (again)")),
            "list_price": (F.col("list_price") * 3).cast(roles.MONEY),
            "standard_cost": (F.col("standard_cost") * 3).cast(roles.MONEY),
            "import_no": F.lit(2),
        }
    )
    return second.unionByName(first)


@register("keep_first_product")
def _keep_first_product(t):
    """The deduplicated product table: the first import of each product."""
    first = quality.keep_first(_imported_products(t), "product_id", "import_no")
    return first.select("product_id", "brand", "product_line", F.col("list_price").cast("double").alias("list_price"))


@register("r1_brand_volume_deduplicated")
def _r1_deduplicated(t):
    """R1 over the deduplicated products; the second imports would add brands."""
    product = quality.keep_first(_imported_products(t), "product_id", "import_no").drop("import_no")
    return R.brands_by_cost_and_volume(product, roles.order_items_role(t.lineitem), min_cost=990, min_quantity=1100)


#: Where the stored products of the registered queries go; a table for each run.
STORED = "velocart_prepared"


def _prepared(t):
    """The role frames after the preparation: products with duplicates audited, kept first and stored in the catalog,
    and read back from there. Each run stores a table of its own name: a session may not know the tables that others
    left in the warehouse, and frames over a replaced table could not be read any more."""
    frames = {
        "product": _imported_products(t),
        "customer": roles.customer_industry_role(t.customer),
        "orders": roles.orders_role(t.orders),
        "order_items": roles.order_items_role(t.lineitem),
    }
    return prepare.prepare_shop(frames, STORED, f"product_new_{uuid.uuid4().hex}", "import_no")


@register("stored_product_new")
def _stored_product_new(t):
    """The stored product table, read back from the catalog."""
    money = [F.col(c).cast("double").alias(c) for c in ("list_price", "standard_cost")]
    return tables.scan_all(t.spark, _prepared(t)["product"]).select("product_id", "brand", "product_line", *money)


@register("r1_stored_product")
def _r1_stored(t):
    """R1 over the stored product table."""
    shop = _prepared(t)
    return R.brands_by_cost_and_volume(shop["product"], shop["order_items"], min_cost=990, min_quantity=1100)


@register("r7_stored_product")
def _r7_stored(t):
    """R7 over the stored product table; the second imports, at three times the price, would be the top products."""
    shop = _prepared(t)
    return R.buyers_of_top_products(
        shop["customer"], shop["orders"], shop["order_items"], shop["product"], line="ECONOMY", k=20, industries=("BUILDING", "MACHINERY"), min_hits=2
    )


@register("r1_brand_volume")
def _r1(t):
    return R.brands_by_cost_and_volume(
        roles.product_role(t.part), roles.order_items_role(t.lineitem), min_cost=990, min_quantity=1100
    )


@register("r2_daily_orders")
def _r2(t):
    return R.daily_orders(roles.orders_from_lineitem(t.lineitem), "1997-04-01", "1997-04-09", status="F")


@register("r3_titles")
def _r3(t):
    return R.titles_by_rules(
        roles.customers_from_parts(t.part, t.lineitem),
        rules=(("ECONOMY", "BLUE%"), ("STANDARD", "Small%")),
        min_age=6,
        as_of="2002-01-15",
    )


def _r4(t, null_brand):
    brand = F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit("/"), F.col("p_size").cast("string"))
    return R.bought_by_a_not_b(
        roles.orders_role(t.orders),
        roles.order_items_role(t.lineitem),
        roles.product_role(t.part, brand=brand),
        roles.customer_industry_role(t.customer, industry=F.col("c_nationkey").cast("string")),
        industry_a="3",
        industry_b="7",
        null_brand=null_brand,
    )


@register("r4a_not_exists")
def _r4a(t):
    return _r4(t, "keep")


@register("r4b_except")
def _r4b(t):
    return _r4(t, "match")


@register("r5_top_customers")
def _r5(t):
    return R.top_customers(
        roles.customer_valuation_role(t.customer),
        roles.orders_role(t.orders),
        roles.order_items_role(t.lineitem),
        roles.product_role(t.part),
        brands=("Brand#1", "Brand#2", "Brand#3"),
        k=10,
        max_states=NATIONS,
    )


@register("r6_lapsed")
def _r6(t):
    return R.lapsed_customers(
        roles.customer_car_role(t.customer),
        roles.orders_role(t.orders),
        status="F",
        excluded_segment="AUTOMOBILE",
    )


@register("r7_top_product_buyers")
def _r7(t):
    price = F.when(F.col("p_brand") == "Brand#1", F.lit(None)).otherwise(F.col("p_retailprice").cast(roles.MONEY))
    return R.buyers_of_top_products(
        roles.customer_industry_role(t.customer),
        roles.orders_role(t.orders),
        roles.order_items_role(t.lineitem),
        roles.product_role(t.part, list_price=price),
        line="ECONOMY",
        k=20,
        industries=("BUILDING", "MACHINERY"),
        min_hits=2,
    )


@register("r8_valuable")
def _r8(t):
    return R.valuable_customers(
        roles.customer_industry_role(t.customer),
        roles.orders_role(t.orders),
        roles.order_items_role(t.lineitem),
        industries=("BUILDING", "HOUSEHOLD"),
        status="F",
        start="1996-01-01",
        end="1998-01-01",
        min_orders=3,
        min_revenue=15_000_000,
    )


# ---- single-purpose operators ------------------------------------------------
AS_OF = "2002-01-15"


def _money(col: str):
    return F.col(col).cast(roles.MONEY)


def _online_flag():
    """A -> true, N -> false, anything else -> unknown."""
    return F.when(F.col("l_returnflag") == "A", F.lit(True)).when(F.col("l_returnflag") == "N", F.lit(False))


@register("load_typed")
def _load_typed(t):
    """Typed load: the part table read with a declared schema (no inference)."""
    return tables.load_typed(t.spark, tables.table_path(t.root, "part"), roles.TEST_SCHEMAS["part"])


@register("scan_all")
def _scan_all(t):
    return tables.scan_all(t.spark, t.part)


@register("scan_customer")
def _scan_customer(t):
    return tables.scan_all(t.spark, t.customer)


@register("scan_orders")
def _scan_orders(t):
    return tables.scan_all(t.spark, t.orders)


@register("scan_lineitem")
def _scan_lineitem(t):
    return tables.scan_all(t.spark, t.lineitem)


@register("scan_summary")
def _scan_summary(t):
    """Row and column counts of the four tables the reports use, as found."""
    frames = {name: getattr(t, name) for name in ("customer", "orders", "part", "lineitem")}
    return tables.scan_summary(t.spark, t.root, frames)


@register("project_columns")
def _project_columns(t):
    return op.project(t.part, ["p_partkey", "p_brand"])


@register("project_rename")
def _project_rename(t):
    return op.project_rename(t.part, {"p_partkey": "product_id", "p_brand": "brand"})


@register("line_revenue")
def _line_revenue(t):
    amount = fx.line_amount(_money("l_extendedprice"), _money("l_quantity"))
    return t.lineitem.select("l_orderkey", amount.cast("double").alias("line_revenue"))


@register("distinct_values")
def _distinct_values(t):
    brand = F.when(F.col("p_brand") == "Brand#1", F.lit(None)).otherwise(F.col("p_brand"))
    return op.distinct_values(t.part.select(brand.alias("brand")), "brand")


@register("filter_eq")
def _filter_eq(t):
    return op.filter_eq(t.orders, "o_orderstatus", "F")


@register("filter_ne")
def _filter_ne(t):
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_mktsegment"))
    return op.filter_ne(t.customer.select("c_custkey", seg.alias("segment")), "segment", "AUTOMOBILE")


@register("filter_gt")
def _filter_gt(t):
    return op.filter_gt(t.part, "p_retailprice", 990)


def _order_dates(t):
    return t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))


@register("filter_range_closed")
def _filter_range_closed(t):
    return op.filter_date_range(_order_dates(t), "order_date", "1997-04-01", "1997-04-09", closed_end=True)


@register("filter_range_halfopen")
def _filter_range_halfopen(t):
    return op.filter_date_range(_order_dates(t), "order_date", "1997-01-01", "1997-03-01", closed_end=False)


@register("filter_is_true")
def _filter_is_true(t):
    flagged = t.lineitem.select("l_orderkey", "l_linenumber", _online_flag().alias("online_order"))
    return op.filter_is_true(flagged, "online_order")


@register("filter_in_list")
def _filter_in_list(t):
    return op.filter_in(t.part, "p_brand", ["Brand#1", "Brand#2", "Brand#3"])


@register("filter_ilike_prefix")
def _filter_ilike_prefix(t):
    return op.filter_ilike(t.part, "p_name", "BLUE%")


def _ages(t):
    return t.orders.select("o_orderkey", fx.age_years(F.col("o_orderdate").cast("date"), AS_OF).alias("age_years"))


@register("fn_age_years")
def _fn_age_years(t):
    return _ages(t)


@register("fn_age_today")
def _fn_age_today(t):
    """Completed years from the order date to the current date."""
    return t.orders.select("o_orderkey", fx.age_years(F.col("o_orderdate").cast("date"), F.current_date()).alias("age_years"))


@register("r3_titles_today")
def _r3_today(t):
    """R3 with ages as of the current date, which is its default."""
    rules = (("ECONOMY", "BLUE%"), ("STANDARD", "Small%"))
    return R.titles_by_rules(roles.customers_from_parts(t.part, t.lineitem), rules=rules, min_age=30)


@register("filter_min_age")
def _filter_min_age(t):
    return _ages(t).filter(F.col("age_years") > 6)


@register("filter_latest_year")
def _filter_latest_year(t):
    dates = _order_dates(t)
    return dates.filter(op.latest_year(dates, "order_date"))


def _quantities(t):
    return t.lineitem.select("l_partkey", "l_suppkey", _money("l_quantity").alias("quantity"))


@register("having_sum")
def _having_sum(t):
    sums = op.sum_by(_quantities(t), "l_partkey", "quantity", "sum_quantity")
    return op.having(sums, F.col("sum_quantity") >= 1000).select(
        "l_partkey", F.col("sum_quantity").cast("double").alias("sum_quantity")
    )


@register("having_count_distinct")
def _having_count_distinct(t):
    counts = op.count_distinct(t.lineitem, "l_partkey", "l_suppkey", "suppliers")
    return op.having(counts, F.col("suppliers") >= 35)


def _customer_revenue(t):
    lines = t.lineitem.select(
        "l_orderkey", fx.line_amount(_money("l_extendedprice"), _money("l_quantity")).alias("amount")
    )
    facts = t.orders.select("o_orderkey", "o_custkey").join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "inner"
    )
    return facts.groupBy("o_custkey").agg(
        F.count_distinct("o_orderkey").alias("orders_count"), F.sum("amount").alias("total_revenue")
    )


@register("having_two")
def _having_two(t):
    agg = _customer_revenue(t)
    cond = (F.col("orders_count") >= 12) & (F.col("total_revenue") > 70_000_000)
    return op.having(agg, cond).select(
        "o_custkey", "orders_count", F.col("total_revenue").cast("double").alias("total_revenue")
    )


@register("agg_sum_product")
def _agg_sum_product(t):
    return _customer_revenue(t).select("o_custkey", F.col("total_revenue").cast("double").alias("total_revenue"))


@register("join_left_using")
def _join_left_using(t):
    o = t.orders.select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate")
    li = t.lineitem.select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey")
    return op.left_join_using(o, li, "order_id")


def _chain(t, how):
    o = t.orders.select("o_orderkey", "o_custkey")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    p = t.part.select("p_partkey", "p_brand")
    c = t.customer.select("c_custkey", "c_mktsegment")
    return (
        o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), how)
        .join(p, F.col("p_partkey") == F.col("l_partkey"), how)
        .join(c, F.col("o_custkey") == F.col("c_custkey"), how)
        .select("o_orderkey", "l_linenumber", "p_brand", "c_mktsegment")
    )


@register("join_left_chain")
def _join_left_chain(t):
    return _chain(t, "left")


@register("join_inner_chain")
def _join_inner_chain(t):
    return _chain(t, "inner")


@register("join_left_semi")
def _join_left_semi(t):
    rich = t.customer.filter(F.col("c_acctbal") > 9000).select(F.col("c_custkey").alias("o_custkey"))
    return op.semi_join(t.orders.select("o_orderkey", "o_custkey"), rich, "o_custkey")


@register("join_left_anti")
def _join_left_anti(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return op.anti_join(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey")


def _orders_per_customer(t):
    return op.count_rows(t.orders.select(F.col("o_custkey").alias("customer_id")), "customer_id", "order_count")


@register("enrich_after_aggregate")
def _enrich_after_aggregate(t):
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name")
    return _orders_per_customer(t).join(names, "customer_id", "left")


@register("agg_count")
def _agg_count(t):
    return op.count_rows(t.orders, "o_orderstatus", "row_count")


@register("agg_count_distinct")
def _agg_count_distinct(t):
    supp = F.when(F.col("l_suppkey") == 7, F.lit(None)).otherwise(F.col("l_suppkey"))
    return op.count_distinct(t.lineitem.select("l_linestatus", supp.alias("supp")), "l_linestatus", "supp", "suppliers")


@register("agg_sum")
def _agg_sum(t):
    return op.sum_by(_quantities(t), "l_partkey", "quantity", "sum_quantity").select(
        "l_partkey", F.col("sum_quantity").cast("double").alias("sum_quantity")
    )


@register("agg_max_global")
def _agg_max_global(t):
    return op.max_global(_order_dates(t), "order_date", "max_order_date")


@register("agg_mixed_distinct")
def _agg_mixed_distinct(t):
    days = t.lineitem.select(F.col("l_shipdate").cast("date").alias("ship_date"), "l_suppkey")
    return days.groupBy("ship_date").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("l_suppkey").alias("suppliers")
    )


def _balances(t):
    return t.customer.select("c_custkey", "c_nationkey", _money("c_acctbal").alias("balance"))


@register("group_mean_window")
def _group_mean_window(t):
    return op.with_group_mean(_balances(t), "c_nationkey", "balance", "group_mean", NATIONS).select(
        "c_custkey", "c_nationkey", "group_mean"
    )


@register("above_group_mean")
def _above_group_mean(t):
    return op.above_group_mean(_balances(t), "c_nationkey", "balance", NATIONS).select(
        "c_custkey", "c_nationkey", F.col("balance").cast("double").alias("balance")
    )


@register("topk_by_column")
def _topk_by_column(t):
    return op.top_k(
        t.part.select("p_partkey", "p_retailprice"), 20, [op.desc("p_retailprice"), op.asc("p_partkey")]
    )


@register("topk_by_aggregate")
def _topk_by_aggregate(t):
    return op.top_k(_orders_per_customer(t), 10, [op.desc("order_count"), op.asc("customer_id")])


def _brands_of(t, ptype):
    return op.distinct_values(t.part.filter(F.col("p_type") == ptype).select(F.col("p_brand").alias("brand")), "brand")


@register("union_all")
def _union_all(t):
    return op.union_all(_brands_of(t, "ECONOMY"), _brands_of(t, "PROMO"))


@register("union_distinct")
def _union_distinct(t):
    return op.union_distinct(_brands_of(t, "ECONOMY"), _brands_of(t, "PROMO"))


@register("except_distinct")
def _except_distinct(t):
    label = F.when(F.col("p_name") == "blue ring", F.lit(None)).otherwise(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))
    )

    def of(ptype):
        return op.distinct_values(t.part.filter(F.col("p_type") == ptype).select(label.alias("label")), "label")

    return op.except_distinct(of("ECONOMY"), of("PROMO"))


@register("fn_year")
def _fn_year(t):
    return op.distinct_values(t.orders.select(fx.calendar_year(F.col("o_orderdate").cast("date")).alias("year")), "year")


@register("fn_cast_date")
def _fn_cast_date(t):
    as_text = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    return t.orders.select("o_orderkey", fx.to_date_strict(as_text).alias("order_date"))
