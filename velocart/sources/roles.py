"""Role bindings: present the driver's test tables as the shop's tables.

The test data is a TPC-H-like schema; the reports speak of products,
customers, orders and order lines. Each binding is a plain projection
(rename, cast, CASE), so Spark still prunes columns and pushes filters into
the Parquet scans underneath it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocart.sources.tables import load_typed, read_table, table_path

MONEY = "decimal(12,2)"
# Fixed binding values: which order priorities count as "online".
ONLINE_PRIORITIES = ("1-URGENT", "2-HIGH")


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_LONG, _INT, _DOUBLE, _STR, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Declared schemas of the driver's tables (as written by its generator), so
# reads need no schema-inference job and a changed file type fails loudly.
TEST_SCHEMAS = {
    "customer": _schema(
        ("c_custkey", _LONG), ("c_name", _STR), ("c_nationkey", _INT), ("c_acctbal", _DOUBLE), ("c_mktsegment", _STR)
    ),
    "orders": _schema(
        ("o_orderkey", _LONG), ("o_custkey", _LONG), ("o_orderstatus", _STR), ("o_totalprice", _DOUBLE),
        ("o_orderdate", _TS), ("o_orderpriority", _STR),
    ),
    "part": _schema(
        ("p_partkey", _LONG), ("p_name", _STR), ("p_brand", _STR), ("p_type", _STR), ("p_size", _INT),
        ("p_retailprice", _DOUBLE),
    ),
    "lineitem": _schema(
        ("l_orderkey", _LONG), ("l_partkey", _LONG), ("l_suppkey", _LONG), ("l_linenumber", _INT),
        ("l_quantity", _DOUBLE), ("l_extendedprice", _DOUBLE), ("l_discount", _DOUBLE), ("l_tax", _DOUBLE),
        ("l_returnflag", _STR), ("l_linestatus", _STR), ("l_shipdate", _TS),
    ),
}


class SourceTables:
    """Access to the driver's Parquet tables under one scale directory; every access lists the files anew.

    An access looks at one footer only; ``load_typed`` and ``check_files`` are the import's check of all files.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in TEST_SCHEMAS:
            return load_typed(self.spark, table_path(self.root, name), TEST_SCHEMAS[name], check="first")
        return read_table(self.spark, self.root, name)


def customer_names() -> list[Column]:
    """customer_id, first_name, last_name from ``c_custkey`` and ``c_name``."""
    return [
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
    ]


def orders_role(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").isin(*ONLINE_PRIORITIES).alias("online_order"),
    )


def order_items_role(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("item_list_price_at_sale"),
    )


def product_role(part: DataFrame, brand: Column | None = None, list_price: Column | None = None) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return part.select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_brand") if brand is None else brand).alias("brand"),
        F.col("p_type").alias("product_line"),
        (price if list_price is None else list_price).alias("list_price"),
        price.alias("standard_cost"),
    )


def orders_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """R2 binding: a line is an "order" dated by its ship date, placed by its
    supplier; return flag A/N/R reads as online true/false/unknown."""
    online = F.when(F.col("l_returnflag") == "A", F.lit(True)).when(F.col("l_returnflag") == "N", F.lit(False))
    return lineitem.select(
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_linestatus").alias("order_status"),
        online.alias("online_order"),
    )


def customers_from_parts(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """R3 binding: one "customer" per order line; title = part name + brand,
    industry = part type, birth date = ship date stored as text."""
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner").select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("job_title"),
        F.col("p_type").alias("job_industry_category"),
        F.col("l_shipdate").cast("date").cast("string").alias("dob"),
    )


def customer_valuation_role(customer: DataFrame) -> DataFrame:
    """R5 binding: state = nation, valuation = balance, deceased above 8000."""
    return customer.select(
        *customer_names(),
        F.col("c_nationkey").cast("string").alias("state"),
        F.col("c_acctbal").cast(MONEY).alias("property_valuation"),
        F.when(F.col("c_acctbal") > 8000, F.lit("Y")).otherwise(F.lit("N")).alias("deceased_indicator"),
    )


def customer_car_role(customer: DataFrame) -> DataFrame:
    """R6 binding: owns a car when the balance is positive; segment = market segment."""
    return customer.select(
        *customer_names(),
        F.when(F.col("c_acctbal") > 0, F.lit("Yes")).otherwise(F.lit("No")).alias("owns_car"),
        F.col("c_mktsegment").alias("wealth_segment"),
    )


def customer_industry_role(customer: DataFrame, industry: Column | None = None) -> DataFrame:
    """Industry = market segment (R7, R8) or any other column (R4: nation)."""
    return customer.select(
        *customer_names(),
        (F.col("c_mktsegment") if industry is None else industry).alias("job_industry_category"),
    )
