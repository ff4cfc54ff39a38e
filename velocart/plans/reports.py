"""The eight shop reports as DataFrame plans.

Inputs are role frames with the shop's column names (see ``velocart.schemas``):
``product`` (already deduplicated), ``customer``, ``orders``, ``order_items``.
Keys are unique in each table (checked with ``duplicate_keys``); the plans
rely on that only where noted. Thresholds, dates and names are parameters
whose defaults are the source script's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocart.functions.scalar import age_years, date_value, holds, line_amount
from velocart.operators.aggregates import above_group_mean
from velocart.operators.relational import broadcast_limited, bucketed_alike, date_range, latest_year
from velocart.operators.topk import asc, desc

# Fixed values of the source script (used as parameter defaults).
COST_THRESHOLD = 1500
VOLUME_THRESHOLD = 1000
APPROVED = "Approved"
R2_START, R2_END = "2017-04-01", "2017-04-09"
TITLE_RULES = (("IT", "senior%"), ("Financial Services", "lead%"))
MIN_AGE = 35
INDUSTRY_A, INDUSTRY_B = "Financial Services", "IT"
TOP_BRANDS = ("Giant Bicycles", "Norco Bicycles", "Trek Bicycles")
TOP_CUSTOMERS = 10
ACTIVE = "N"
OWNS_CAR = "Yes"
EXCLUDED_SEGMENT = "Mass Customer"
ROAD_LINE = "Road"
TOP_PRODUCTS = 5
MIN_TOP_PRODUCTS = 2
R7_INDUSTRIES = ("IT",)
R8_INDUSTRIES = ("IT", "Health")
R8_START, R8_END = "2017-01-01", "2017-03-01"
MIN_ORDERS = 3
MIN_REVENUE = 10000


def brands_by_cost_and_volume(
    product: DataFrame, order_items: DataFrame, min_cost=COST_THRESHOLD, min_quantity=VOLUME_THRESHOLD
) -> DataFrame:
    """R1. Brands with one product that both costs more than ``min_cost`` and
    sold at least ``min_quantity`` units in total.

    Both conditions hold on the same product. A product without sales has a
    NULL sum and fails; a NULL brand is one output row. Quantities are summed
    per product first, so only partial sums are shuffled, never lines, and
    then meet the costly products.
    """
    costly = product.filter(F.col("standard_cost") > F.lit(min_cost)).select("product_id", "brand")
    volume = (
        order_items.groupBy("product_id")
        .agg(F.sum("quantity").alias("sum_quantity"))
        .filter(F.col("sum_quantity") >= F.lit(min_quantity))
    )
    return costly.join(volume, "product_id", "inner").select("brand").distinct()


def daily_orders(
    orders: DataFrame,
    start=R2_START,
    end=R2_END,
    status: str = APPROVED,
) -> DataFrame:
    """R2. Per day in ``[start, end]``: approved online orders and distinct
    customers. Days without such orders have no row."""
    return (
        orders.filter(
            date_range("order_date", start, end, closed_end=True)
            & (F.col("order_status") == F.lit(status))
            & holds("online_order")
        )
        .groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.count_distinct("customer_id").alias("count_customers"),
        )
        .orderBy(asc("order_date"))
    )


def titles_by_rules(
    customer: DataFrame,
    rules: Sequence[tuple[str, str]] = TITLE_RULES,
    min_age: int = MIN_AGE,
    as_of=None,
) -> DataFrame:
    """R3. ``union all`` over rules of the distinct job titles of customers in
    the rule's industry whose title matches the rule's ILIKE pattern and who
    are older than ``min_age`` completed years on ``as_of``.

    One scan for all rules: each row is tagged with the rules it meets, and
    the distinct is taken per (rule, title), which is exactly a union all of
    per-rule distinct sets. ``as_of=None`` means today.
    """
    as_of_col = F.current_date() if as_of is None else date_value(as_of)
    old_enough = age_years("dob", as_of_col) > F.lit(min_age)
    tags = [
        F.when(
            (F.col("job_industry_category") == F.lit(industry)) & F.col("job_title").ilike(pattern),
            F.lit(i),
        )
        for i, (industry, pattern) in enumerate(rules)
    ]
    industries = sorted({industry for industry, _ in rules})
    return (
        customer.filter(F.col("job_industry_category").isin(industries) & old_enough)
        .select("job_title", F.explode(F.array_compact(F.array(*tags))).alias("__rule"))
        .distinct()
        .select("job_title")
    )


def _brand_flags(
    orders: DataFrame,
    order_items: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    industry_a: str,
    industry_b: str,
) -> DataFrame:
    """Per brand: bought by industry A? by industry B?

    Facts are ``orders ⟕ order_items ⟕ product ⋈ customer``; an order with no
    line, or a line without a product, has a NULL brand. The order of the
    joins follows the layout. On plain tables the two industries' customers
    cut the orders first, and what is left meets the lines: lines are
    exchanged once, by order. On facts stored bucketed by order, orders meet
    their lines first, which exchanges neither. The flags are OR-ed per
    product and again per brand; only partial rows cross those shuffles.
    """
    industry = F.col("job_industry_category")
    buyers = customer.filter(industry.isin(industry_a, industry_b)).select(
        "customer_id",
        (industry == F.lit(industry_a)).alias("__a"),
        (industry == F.lit(industry_b)).alias("__b"),
    )
    placed, lines = orders.select("order_id", "customer_id"), order_items.select("order_id", "product_id")
    if bucketed_alike(orders, order_items, "order_id"):
        bought = placed.join(lines, "order_id", "left").join(buyers, "customer_id", "inner")
    else:
        bought = placed.join(buyers, "customer_id", "inner").join(lines, "order_id", "left")
    per_product = bought.groupBy("product_id").agg(F.bool_or("__a").alias("__a"), F.bool_or("__b").alias("__b"))
    return (
        per_product.join(product.select("product_id", "brand"), "product_id", "left")
        .groupBy("brand")
        .agg(F.bool_or("__a").alias("bought_a"), F.bool_or("__b").alias("bought_b"))
    )


def bought_by_a_not_b(
    orders: DataFrame,
    order_items: DataFrame,
    product: DataFrame,
    customer: DataFrame,
    industry_a: str = INDUSTRY_A,
    industry_b: str = INDUSTRY_B,
    null_brand: str = "keep",
) -> DataFrame:
    """R4. Brands bought by customers of ``industry_a`` and not of ``industry_b``.

    ``null_brand="keep"`` is the NOT EXISTS form: a NULL brand never equals
    anything, so it is returned whenever A has it. ``"match"`` is the EXCEPT
    form: NULL equals NULL, so it is dropped when B has it too.
    """
    flags = _brand_flags(orders, order_items, product, customer, industry_a, industry_b)
    if null_brand == "keep":
        cond = F.col("bought_a") & (F.col("brand").isNull() | ~F.col("bought_b"))
    elif null_brand == "match":
        cond = F.col("bought_a") & ~F.col("bought_b")
    else:
        raise ValueError("null_brand must be 'keep' or 'match'")
    return flags.filter(cond).select("brand")


def top_customers(
    customer: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    product: DataFrame,
    brands: Sequence[str] = TOP_BRANDS,
    k: int = TOP_CUSTOMERS,
    active_value: str = ACTIVE,
    max_states: int | None = None,
) -> DataFrame:
    """R5. The ``k`` customers with most distinct online orders containing a
    product of ``brands``, among active customers whose property valuation is
    above their state's mean (mean over all customers of the state, the
    deceased included). Ties go to the lower customer id.

    ``max_states`` declares a bound on the number of states, so that their
    statistics are broadcast (with more states the query fails); the other
    sides are left to the planner.
    """
    qualified = above_group_mean(customer, "state", "property_valuation", max_states).filter(
        F.col("deceased_indicator") == F.lit(active_value)
    )
    wanted = product.filter(F.col("brand").isin(list(brands))).select("product_id")
    counts = (
        orders.filter(holds("online_order"))
        .select("order_id", "customer_id")
        .join(qualified.select("customer_id"), "customer_id", "left_semi")
        .join(order_items.select("order_id", "product_id"), "order_id", "inner")
        .join(wanted, "product_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("count_order"))
    )
    ranking = [desc("count_order"), asc("customer_id")]
    top = counts.orderBy(*ranking).limit(k)
    # the customers are streamed once through a semi join on the k ids (k at
    # most, by the limit), so an outer join never shuffles the whole table
    names = customer.select("customer_id", "first_name", "last_name").join(
        broadcast_limited(top.select("customer_id"), k), "customer_id", "left_semi"
    )
    return (
        top.join(names, "customer_id", "left")
        .select("customer_id", "first_name", "last_name", "count_order")
        .orderBy(*ranking)
    )


def lapsed_customers(
    customer: DataFrame,
    orders: DataFrame,
    status: str = APPROVED,
    owns_car: str = OWNS_CAR,
    excluded_segment: str = EXCLUDED_SEGMENT,
) -> DataFrame:
    """R6. Car owners outside ``excluded_segment`` with no approved online
    order in the calendar year of the latest order date (over all orders).

    The latest year is a date range from a scalar sub-query (``latest_year``),
    which prunes row groups and date folders. A NULL segment fails ``<>``; a customer with a NULL id is never matched, so it
    stays (NOT EXISTS semantics).
    """
    recent = (
        orders.filter((F.col("order_status") == F.lit(status)) & holds("online_order") & latest_year(orders, "order_date"))
        .select("customer_id")
        .distinct()
    )
    return (
        customer.filter(
            (F.col("owns_car") == F.lit(owns_car)) & (F.col("wealth_segment") != F.lit(excluded_segment))
        )
        .join(recent, "customer_id", "left_anti")
        .select("customer_id", "first_name", "last_name")
    )


def buyers_of_top_products(
    customer: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    product: DataFrame,
    line: str = ROAD_LINE,
    k: int = TOP_PRODUCTS,
    industries: Sequence[str] = R7_INDUSTRIES,
    min_hits: int = MIN_TOP_PRODUCTS,
) -> DataFrame:
    """R7. Customers of ``industries`` who bought at least ``min_hits`` of the
    ``k`` products of ``line`` with the highest list price (a NULL price
    ranks highest; ties go to the lower product id).

    The top-k set has at most ``k`` rows, so it is broadcast and filters the
    line items map-side before anything is shuffled. Only the few distinct
    (order, product) rows left meet the orders, and only then the customers.
    """
    top = broadcast_limited(
        product.filter(F.col("product_line") == F.lit(line))
        .orderBy(desc("list_price"), asc("product_id"))
        .limit(k)
        .select("product_id"),
        k,
    )
    buyers = customer.filter(F.col("job_industry_category").isin(list(industries)))
    bought = order_items.select("order_id", "product_id").join(top, "product_id", "inner").distinct()
    hits = (
        bought.join(orders.select("order_id", "customer_id"), "order_id", "inner")
        .join(buyers.select("customer_id"), "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.count_distinct("product_id").alias("products_count"))
        .filter(F.col("products_count") >= F.lit(min_hits))
    )
    return hits.join(buyers, "customer_id", "inner").select("customer_id", "first_name", "last_name")


def valuable_customers(
    customer: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    industries: Sequence[str] = R8_INDUSTRIES,
    status: str = APPROVED,
    start=R8_START,
    end=R8_END,
    min_orders: int = MIN_ORDERS,
    min_revenue=MIN_REVENUE,
) -> DataFrame:
    """R8. Customers of ``industries`` with at least ``min_orders`` distinct
    approved orders in ``[start, end)`` whose lines total more than
    ``min_revenue``; one row per customer, sorted by industry then id.

    The per-industry UNION of the source is one pass here: the industries
    are disjoint filters of the same rows. Orders are restricted to the
    industries' customers with a semi join, which equals the source's inner
    join when customer ids are unique (the audited key contract). At scale a
    runtime Bloom filter of those orders cuts the lines before their shuffle
    (see ``session.sizing_conf``).
    """
    buyers = customer.filter(F.col("job_industry_category").isin(list(industries)))
    summary = (
        orders.filter(
            (F.col("order_status") == F.lit(status)) & date_range("order_date", start, end, closed_end=False)
        )
        .select("order_id", "customer_id")
        .join(buyers.select("customer_id"), "customer_id", "left_semi")
        .join(order_items.select("order_id", "item_list_price_at_sale", "quantity"), "order_id", "inner")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("orders_count"),
            F.sum(line_amount("item_list_price_at_sale", "quantity")).alias("total_revenue"),
        )
        .filter((F.col("orders_count") >= F.lit(min_orders)) & (F.col("total_revenue") > F.lit(min_revenue)))
    )
    return (
        summary.join(buyers, "customer_id", "inner")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            F.col("job_industry_category").alias("industry"),
        )
        .distinct()
        .orderBy(asc("industry"), asc("customer_id"))
    )
