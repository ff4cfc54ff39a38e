"""Typed schemas of the four source tables of the shop.

The source script never declares types; they follow from how each column is
used (compared with text, summed, cast to a date, tested with IS TRUE).
Money is exact decimal so sums and mean comparisons do not depend on row
order or on floating point.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("brand", T.StringType()),
    T.StructField("product_line", T.StringType()),
    T.StructField("product_class", T.StringType()),
    T.StructField("product_size", T.StringType()),
    T.StructField("list_price", MONEY),
    T.StructField("standard_cost", MONEY),
])

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("job_industry_category", T.StringType()),
    # stored as text by the importer; cast to a date where it is used
    T.StructField("dob", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("property_valuation", T.IntegerType()),
    T.StructField("deceased_indicator", T.StringType()),
    T.StructField("owns_car", T.StringType()),
    T.StructField("wealth_segment", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("online_order", T.BooleanType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_item_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("item_list_price_at_sale", MONEY),
])

# Business key of each table, audited for duplicates before any join.
KEYS = {
    "product": ["product_id"],
    "customer": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
}
