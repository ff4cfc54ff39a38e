"""The shared folder for intermediate tables, and keys of rows.

Intermediate tables are Parquet under the folder that the cluster names in
``spark.checkpoint.dir``: any executor can read them, and a lost executor
costs no recomputation of what was written.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a file that one map of places covers, a bit a row.
SPAN = 4096
#: Maps (1.2 KB at most, and a file name) that are broadcast: 134 million rows at least, 40 MB at most.
MAPS = 32_768


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share. Only a local session without the setting gets a scratch folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="velocart-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started: Spark hands them a zip of it."""
    context = spark.sparkContext
    if getattr(context, "_velocart_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="velocart-zip-"), "velocart"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)
    context._velocart_shipped = True


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/velocart-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._velocart_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` or ``bucketed`` gave and nothing will read again: all that was made
    of them must be written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._velocart_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """Write ``df`` to the shared folder in ``n`` buckets by ``key`` and read it back: groups and joins by ``key`` that
    are dealt over ``n`` partitions move the other side only. The catalog forgets the table; its files stay."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    table = os.path.basename(path).replace("-", "_")
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    back._velocart_path = path
    return back


def on_files(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` itself if it is a projection or filter of Parquet files that gives the same rows at each read, else a
    copy in the shared folder."""
    analyzed = docs._jdf.queryExecution().analyzed()
    plan = analyzed.toString()
    nodes = {line.lstrip(" :+-").split(" ")[0] for line in plan.splitlines() if line.strip()}
    if analyzed.deterministic() and nodes <= {"Project", "Filter", "Relation"} and "parquet" in plan and "_metadata" not in docs.columns:
        return docs
    return stored(docs, name)


def located(docs: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """``columns`` of ``docs`` plus ``file`` and ``row``, which tell equal rows apart.

    The locator is the place of the row in its Parquet file, so it is the same
    in every run over the same files. A frame that is more than a projection
    or filter of Parquet files is written to the shared folder first.
    """
    back = on_files(docs, name)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return back.select(*[c.alias(k) for k, c in columns.items()], *place)


def rows_at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The ``rows`` (with file and row, each place once) that stand at ``places`` (file, row).

    The places travel, one bit each, and the rows stay where they are read: a
    map covers ``SPAN`` rows of a file. Up to ``MAPS`` maps are broadcast;
    beyond that, maps and rows are joined by shuffles, at most ``SPAN`` rows a
    key. Places may repeat; a null place is nowhere.
    """
    places = places.select("file", "row").dropna()
    words = places.groupBy("file", F.expr("row div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(row % 64 AS int)))").alias("bits"))
    entry = F.struct((F.col("word") % (SPAN // 64)).alias("word"), "bits")
    maps = words.groupBy("file", F.expr(f"word div {SPAN // 64}").alias("span")).agg(F.map_from_entries(F.collect_list(entry)).alias("bits"))
    maps = stored(maps, "places")
    if maps.limit(MAPS + 1).count() <= MAPS:
        maps = F.broadcast(maps)
    bits = f"coalesce(try_element_at(p.bits, r.row div 64 % {SPAN // 64}), 0L)"
    met = rows.alias("r").join(maps.alias("p"), F.expr(f"r.file = p.file AND r.row div {SPAN} = p.span"))
    return met.filter(F.expr(f"getbit({bits}, cast(r.row % 64 AS int)) = 1")).select("r.*")


def documents_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``docs`` (on files), with all their columns, that stand at ``places`` (file, row)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return rows_at(located(docs, {"document": whole}, "documents"), places).select("document.*")


def slices(spark: SparkSession, factor: int = 1) -> int:
    """Hash slices of a shuffle: as many as the session's shuffle partitions, times ``factor``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * factor)
