"""The preparation step that precedes the reports.

The source workflow audits every table for duplicate keys, keeps the first
record per key of the one table that has duplicates (products), and stores
the result as a new table that all later reports read. Optionally, the two
fact tables are stored bucketed on the order key so that the order/line
join of R4, R5, R7 and R8 runs without shuffling either side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from velocart.operators.quality import duplicate_keys, keep_first
from velocart.schemas import KEYS
from velocart.sources.tables import create_namespace, save_table


def audit_tables(
    frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEYS
) -> dict[str, DataFrame]:
    """Duplicate-key audit of each table: ``{name: (key..., row_count)}``."""
    return {name: duplicate_keys(df, list(keys[name])) for name, df in frames.items()}


def store_first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | str,
    table: str,
    mode: str = "errorifexists",
    bucket_by: tuple[int, list[str]] | None = None,
) -> DataFrame:
    """``create table T as`` the first row per key; returns the stored table.

    Reading the stored table back cuts the lineage: later reports start from
    files on shared storage, not from the deduplication plan.
    """
    save_table(keep_first(df, list(keys), order_by), table, mode=mode, bucket_by=bucket_by)
    return df.sparkSession.table(table)


def prepare_shop(
    frames: Mapping[str, DataFrame],
    namespace: str,
    product_table: str = "product_new",
    order_by: Sequence[str | Column] | str = "file_order",
    mode: str = "errorifexists",
) -> dict[str, DataFrame]:
    """The whole preparation: create the namespace, keep the first record of each product, store it, read it back.

    ``frames`` are the role frames (product, customer, orders, order_items);
    returned are the same, with the stored table in place of ``product``. The
    stored table has the product's columns (without an import sequence that
    ``order_by`` names).
    """
    create_namespace(frames["product"].sparkSession, namespace)
    sequence = [c for c in ([order_by] if isinstance(order_by, str) else order_by) if isinstance(c, str)]
    first = keep_first(frames["product"], list(KEYS["product"]), order_by).drop(*sequence)
    save_table(first, f"{namespace}.{product_table}", mode=mode)
    return {**frames, "product": first.sparkSession.table(f"{namespace}.{product_table}")}


def store_facts_bucketed(
    orders: DataFrame,
    order_items: DataFrame,
    buckets: int,
    orders_table: str,
    items_table: str,
    mode: str = "errorifexists",
) -> tuple[DataFrame, DataFrame]:
    """Store orders and order lines bucketed and sorted by ``order_id``.

    Both tables must use the same bucket count; joins on ``order_id`` then
    read matching buckets directly (no exchange on either side).
    """
    save_table(orders, orders_table, mode=mode, bucket_by=(buckets, ["order_id"]))
    save_table(order_items, items_table, mode=mode, bucket_by=(buckets, ["order_id"]))
    spark = orders.sparkSession
    return spark.table(orders_table), spark.table(items_table)


def analyze_tables(spark, tables: Sequence[str], columns: bool = True) -> None:
    """Compute catalog statistics for stored tables (a distributed job each).

    With row counts and column statistics in the catalog, and
    ``spark.sql.cbo.enabled=true`` in the session, the planner estimates
    filtered sizes and join outputs from the data instead of from file
    sizes, so broadcast and join-order choices follow the real sizes.
    """
    for table in tables:
        target = "FOR ALL COLUMNS" if columns else ""
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {target}".strip())
