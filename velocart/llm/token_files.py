"""Token-id files: Parquet list columns in ascending document order.

File format: one row a document with its ids as list<int>, the number of ids
and the ids before it in its file. Ids are dictionary-encoded, the sorted and
running integers delta-encoded (Parquet v2 pages); row groups and pages are
kept small, so that the page index lets a reader fetch the metadata columns
alone, or the pages of a few documents.

Defined results: a null text is an empty one (its end id only); a null id
sorts first; rows with equal ids are ordered by their text; an empty table
gives an empty folder of files; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velocart.llm.store import slices
from velocart.llm.tokens import worker_encoder
from velocart.llm.words import text_chunks

SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"
#: Writer settings: v2 pages give delta encoding where no dictionary is used.
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#before": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", files: int | None = None
) -> None:
    """Encode ``text`` and write ``files`` files (default: the shuffle partitions) in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    encoder = worker_encoder(spark, tokenizer)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(files or slices(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches):
        part, before, own = TaskContext.get().partitionId(), 0, encoder()
        for batch in text_chunks(batches, "text"):
            ids, at = own.encode(batch.column(1), end_id)
            n = len(at) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(before + at[:-1]),
                    pa.array(np.diff(at)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                ],
                ["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(at[-1])

    rows.mapInArrow(encode, SCHEMA).write.options(**FORMAT).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the number of ids of all documents before.

    Only the two integers of one row a file meet in one task.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers) of read rows."""

    def crc(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = np.asarray(ids.flatten(), dtype="<u4")
            at = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))])
            codes = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(codes, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
