"""Loading and storing tables.

The source workflow imports four tables with a desktop tool, browses them,
and stores one derived table (``create table ... as``). Here the import is a
typed load (explicit schema, fail fast on malformed rows) and the stored
table is a managed table written by the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocart.functions.scalar import cast_strict


def table_path(root: str, name: str) -> str:
    """Location of table ``name`` (one Parquet dataset per table) under ``root``."""
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one Parquet table; Spark prunes columns and pushes filters into the scan."""
    return spark.read.parquet(table_path(root, name))


# What a Parquet column may hold for a declared type: its physical type in the file.
_PHYSICAL = {
    "bigint": {"INT64", "INT32"}, "int": {"INT32"}, "smallint": {"INT32"}, "tinyint": {"INT32"}, "double": {"DOUBLE", "FLOAT"},
    "float": {"FLOAT"}, "string": {"BINARY"}, "binary": {"BINARY"}, "boolean": {"BOOLEAN"}, "date": {"INT32"},
    "timestamp": {"INT64", "INT96"}, "timestamp_ntz": {"INT64", "INT96"},
}


def file_columns(spark: SparkSession, path: str) -> dict[str, str]:
    """Columns of a Parquet dataset as found: name and physical type, from the footer of its first file.

    Read on the driver through the file system Spark uses for the path; no
    Spark job is started. A nested column has the type ``group``.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf).listFiles(root, True)
    first = None
    while files.hasNext():
        file = files.next().getPath()
        hidden = any(part[:1] in "_." for part in file.toString()[len(root.toString()) :].split("/") if part)
        if not hidden and (first is None or file.toString() < first.toString()):
            first = file
    if first is None:
        raise FileNotFoundError(f"no Parquet file in {path}")
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(first, conf)
    )
    try:
        fields = reader.getFooter().getFileMetaData().getSchema().getFields()
        return {
            f.getName(): f.asPrimitiveType().getPrimitiveTypeName().toString() if f.isPrimitive() else "group" for f in fields
        }
    finally:
        reader.close()


def _check_columns(spark: SparkSession, path: str, schema: T.StructType) -> None:
    found = file_columns(spark, path)
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(found)}")
    for f in schema.fields:
        allowed = _PHYSICAL.get(f.dataType.simpleString())
        if allowed and found[f.name] not in allowed:
            raise ValueError(f"{path}: column {f.name} is stored as {found[f.name]}, declared {f.dataType.simpleString()}")


# What the files' common type of a column may be for a declared type.
_READABLE = {
    "bigint": {"bigint", "int", "smallint", "tinyint"}, "int": {"int", "smallint", "tinyint"}, "smallint": {"smallint", "tinyint"},
    "double": {"double", "float"}, "timestamp": {"timestamp", "timestamp_ntz"}, "timestamp_ntz": {"timestamp", "timestamp_ntz"},
}

# Two different values of each type, as SQL, that data seldom hold: they stand for a column that a file lacks.
_STAND_INS = {
    "bigint": ("-9223372036854775807L", "-9223372036854775806L"), "int": ("-2147483647", "-2147483646"), "smallint": ("-32767S", "-32766S"),
    "tinyint": ("-127Y", "-126Y"), "double": ("-1.7976931348623157E308D", "-1.7976931348623156E308D"),
    "float": ("CAST(-3.4E38D AS FLOAT)", "CAST(-3.3E38D AS FLOAT)"), "string": ("'(no such column) 1'", "'(no such column) 2'"),
    "boolean": ("true", "false"), "date": ("DATE'0001-01-01'", "DATE'0001-01-02'"),
    "timestamp": ("TIMESTAMP'0001-01-02 00:00:00'", "TIMESTAMP'0001-01-03 00:00:00'"),
    "timestamp_ntz": ("TIMESTAMP_NTZ'0001-01-02 00:00:00'", "TIMESTAMP_NTZ'0001-01-03 00:00:00'"),
}


def _stand_ins(data_type: T.DataType) -> tuple[str, str] | None:
    if isinstance(data_type, T.DecimalType):
        return f"CAST(0 AS {data_type.simpleString()})", f"CAST(1E-{data_type.scale} AS {data_type.simpleString()})"
    return _STAND_INS.get(data_type.simpleString())


def missing_columns(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, column_name): the files of a Parquet dataset, with rows, that lack a declared column of a simple type
    (neither binary nor nested: Parquet readers take no defaults for those).

    Spark reads a column that a file lacks as its field's default value. The
    dataset is scanned twice, each time with another default and only for rows
    that hold it: a file lacks the column if and only if all its rows do, both
    times. The comparison reaches the Parquet reader, so of files that have
    their columns little more than the footers is read (booleans are read
    whole). All on the executors, by the readers that also load the data.
    """
    fields = [f for f in schema.fields if _stand_ins(f.dataType)]
    file = F.col("_metadata.file_path").alias("file")
    found = spark.read.schema(schema).parquet(path).select(file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    for k in (0, 1):
        given = [(f, _stand_ins(f.dataType)[k]) for f in fields]
        read = T.StructType([T.StructField(f.name, f.dataType, True, {"EXISTS_DEFAULT": v, "CURRENT_DEFAULT": v}) for f, v in given])
        holds = [F.col(f"`{f.name}`") == F.expr(v) for f, v in given]
        some = holds[0]
        for h in holds[1:]:
            some = some | h
        rows = spark.read.schema(read).parquet(path).filter(some).select(file, *[h.alias(f"h{i}") for i, h in enumerate(holds)])
        hits = rows.groupBy("file").agg(*[F.count_if(F.col(f"h{i}")).alias(f"n{k}_{i}") for i in range(len(fields))])
        found = found.join(hits, "file")
    lacking = [
        F.when((F.col(f"n0_{i}") == F.col("rows")) & (F.col(f"n1_{i}") == F.col("rows")), F.lit(f.name)) for i, f in enumerate(fields)
    ]
    return found.select("file", F.explode(F.array_compact(F.array(*lacking))).alias("column_name"))


def dataset_types(spark: SparkSession, path: str) -> dict[str, str]:
    """Columns of all files of a Parquet dataset and their types, from all footers (read by the executors); files that
    store a column in different types are an error."""
    try:
        merged = spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as error:
        if "CANNOT_MERGE" in str(error):
            raise ValueError(f"{path}: files store a column in different types: {str(error)[:600]}") from error
        raise
    return {f.name: f.dataType.simpleString() for f in merged.fields}


def check_files(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Raise if any file of a Parquet dataset lacks a declared column or stores it in another type.

    An import check: it runs jobs over all footers. A dataset of one file needs none, its footer is read on the driver.
    """
    if len(spark.read.schema(schema).parquet(path).inputFiles()) <= 1:
        return _check_columns(spark, path, schema)
    found = dataset_types(spark, path)
    absent = [f.name for f in schema.fields if f.name not in found]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; it has {', '.join(found)}")
    for f in schema.fields:
        declared = f.dataType.simpleString()
        if found[f.name] not in _READABLE.get(declared, {declared}):
            raise ValueError(f"{path}: column {f.name} is stored as {found[f.name]}, declared {declared}")
    lacking = missing_columns(spark, path, schema).orderBy("file", "column_name").limit(5).collect()
    if lacking:
        raise ValueError("files without a declared column: " + "; ".join(f"{r.file} has no column {r.column_name}" for r in lacking))


def load_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    header: bool = True,
    check: str = "all",
) -> DataFrame:
    """Load a file source with a declared schema; never infer.

    Wrong data fails loudly: every file of a Parquet dataset must have the
    declared columns in a matching type (checked at once, by the executors
    where there are several files; ``check="first"`` looks at the footer of
    the first file alone, for datasets that an import has checked); a CSV
    header must name the columns in their order, and a malformed row stops the
    job whatever columns are read; JSON stops on malformed rows.
    """
    reader = spark.read.schema(schema)
    if fmt == "parquet":
        if check not in ("all", "first"):
            raise ValueError("check must be 'all' or 'first'")
        (check_files if check == "all" else _check_columns)(spark, path, schema)
    elif fmt == "csv":
        reader = reader.option("header", header).option("mode", "FAILFAST").option("enforceSchema", not header)
    elif fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    df = reader.format(fmt).load(path)
    if fmt in ("csv", "json"):
        # always true, but it reads every column: a malformed value stops also
        # a job that needs other columns only, or none (a count)
        df = df.filter(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) >= F.lit(-(2**63)))
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, order and types.

    Columns must already exist under the schema's names; each is cast to the
    declared type, and a value that does not fit is an error in any session.
    """
    return df.select(*[cast_strict(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def scan_all(spark: SparkSession, name_or_df) -> DataFrame:
    """``select * from t`` for a catalog table name or a DataFrame."""
    df = spark.table(name_or_df) if isinstance(name_or_df, str) else name_or_df
    return df.select("*")


def _column_count(spark: SparkSession, path: str) -> int:
    if len(spark.read.schema(T.StructType([])).parquet(path).inputFiles()) <= 1:
        return len(file_columns(spark, path))
    return len(dataset_types(spark, path))


def scan_summary(spark: SparkSession, root: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The import check: one row per table with its row count and the columns that all its files together have.

    Each count is a global aggregate over a full scan (Parquet answers it
    from footers where it can); the per-table rows are unioned, so all
    tables are checked in one job.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(_column_count(spark, table_path(root, name))).alias("column_count"),
        )
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def create_namespace(spark: SparkSession, name: str) -> None:
    """``create schema if not exists name``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def _drop_with_folder(spark: SparkSession, name: str) -> None:
    """Drop a managed table that may not be in the catalog yet, and the folder its files would be in."""
    namespace, _, table = name.rpartition(".")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    described = spark.sql(f"DESCRIBE NAMESPACE {namespace or spark.catalog.currentDatabase()}").collect()
    root = next(r[1] for r in described if r[0] == "Location")
    folder = spark._jvm.org.apache.hadoop.fs.Path(root, table.strip("`").lower())
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "errorifexists",
    bucket_by: tuple[int, list[str]] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """``create table name as select ...``: all or nothing, and fails if the table exists.

    The rows are written as a table of another, new name, which takes its name
    only when it is whole: a write that fails leaves neither a table nor a
    folder, and a second run works. ``mode="overwrite"`` replaces the old
    table then, and not before; the new rows may come from the old table.
    ``bucket_by=(n, keys)`` stores the table bucketed and sorted on its key,
    so later joins and aggregates on that key read it without a shuffle.
    ``partition_by`` stores one folder per value (e.g. ``order_date``), so
    filters on that column skip whole folders instead of scanning them.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("mode must be 'errorifexists' or 'overwrite'")
    spark = df.sparkSession
    if mode == "errorifexists" and spark.catalog.tableExists(name):
        raise AnalysisException(f"table {name} already exists")
    staging = f"{name}__staging_{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        buckets, keys = bucket_by
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    try:
        writer.saveAsTable(staging)
        if mode == "overwrite":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        if partition_by:  # some catalogs keep the folders' old names
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    except BaseException:
        _drop_with_folder(spark, staging)
        raise
