"""Exact deduplication by a stream with disk-backed keyed state.

Every document arrives on a stream as (digest, stable identifier, content
locator). The stream keeps one entry a digest, for ever (no watermark), in
RocksDB: the row that stays and the number of rows. Where a digest was seen
more than once, the locators fetch the texts and all their bytes are compared.
DataFrame functions only.

Defined results: a null text counts as empty; a null id is smaller than any
other, so such a row stays only if no copy has an id; of rows equal in text
and id exactly one stays; an empty table gives no rows; further columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velocart.llm.store import documents_at, located, new_path, on_files, rows_at, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty. ``lower`` does the same where a text has only ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


@contextmanager
def _conf(spark: SparkSession, keys: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_state(spark: SparkSession, arrivals: str, schema, checkpoint: str | None = None) -> DataFrame:
    """Run the stream over the Parquet folder ``arrivals``; one row a key: key, keep (doc_id, file, row), n.

    With the ``checkpoint`` folder of an earlier run the stream goes on from
    there: only files that came since are read, against the state retained.
    """
    checkpoint = checkpoint or new_path(spark, "dedup-state")
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # many small stores: no room reserved ahead, only changes uploaded
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    with _conf(spark, settings):
        entries = (
            spark.readStream.schema(schema)
            .parquet(arrivals)
            .groupBy("key")
            .agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        )
        query = (
            entries.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        keep, n = (F.col(f"value.`{f.name}`") for f in state.schema["value"].dataType.fields)
        return state.select(F.col("key.key").alias("key"), keep.alias("keep"), n.alias("n"))


def dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    state_key: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256, file, row (its locator).

    ``state_key`` derives the key of the state from the SHA-256 (default: all
    of it); a weak one only makes more hits, which the byte check tells apart.
    """
    spark = docs.sparkSession
    source = located(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text": F.col(f"`{text}`").cast("string")}, "dedup-docs")
    sha = F.unhex(F.sha2(lower_ascii(F.col("text")), 256))
    state_key = state_key or (lambda c: c)
    arrivals = source.select("doc_id", "file", "row", sha.alias("sha"))
    arrivals = arrivals.withColumn("key", state_key(F.col("sha")))
    path = new_path(spark, "dedup-arrivals")
    arrivals.write.parquet(path)
    state = stream_state(spark, path, arrivals.schema)
    rows = stored(spark.read.schema(arrivals.schema).parquet(path).join(state, "key"), "dedup-rows")

    # full bytes on hits: the texts of a key that came more than once, one row a different text
    texts = rows_at(source, rows.filter("n > 1")).withColumn("key", state_key(sha)).withColumn("text", lower_ascii(F.col("text")))
    variants = texts.groupBy("key", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep2"), F.count(F.lit(1)).alias("n2"))
    clash = stored(variants.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "dedup-clash")
    if not clash.isEmpty():  # one digest, different bytes: those keys are grouped by their texts
        exact = texts.join(clash.select("key"), "key").join(variants, ["key", "text"]).select("file", "row", "keep2", "n2")
        rows = rows.join(exact, ["file", "row"], "left").withColumns({"keep": F.coalesce("keep2", "keep"), "n": F.coalesce("n2", "n")})
    return rows.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "file",
        "row",
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that stay."""
    docs = on_files(docs, "dedup-docs")
    return documents_at(docs, dedup(docs).filter("kept"))
