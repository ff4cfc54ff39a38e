"""Namespace creation, create-table-as-select, typed loads."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from velocart.operators import keep_first
from velocart.schemas import PRODUCT
from velocart.sources import conform, create_namespace, file_columns, load_typed, missing_columns, save_table, scan_all, scan_summary, table_path
from velocart.sources.roles import TEST_SCHEMAS, SourceTables

TEST_PART = TEST_SCHEMAS["part"]


def test_namespace_and_ctas_fails_when_table_exists(spark):
    create_namespace(spark, "shop_stg")
    create_namespace(spark, "shop_stg")  # if not exists: no error
    df = spark.createDataFrame([(1, "A", 1), (1, "B", 0), (2, "C", 0)], "product_id long, brand string, seq int")
    save_table(keep_first(df, "product_id", ["seq"]).drop("seq"), "shop_stg.product_new")
    stored = scan_all(spark, "shop_stg.product_new")
    assert sorted(tuple(r) for r in stored.collect()) == [(1, "B"), (2, "C")]
    with pytest.raises(AnalysisException):
        save_table(df, "shop_stg.product_new")


def test_bucketed_table_joins_without_shuffle_on_key(spark):
    create_namespace(spark, "shop_stg")
    df = spark.range(1000).selectExpr("id as product_id", "id % 7 as v")
    save_table(df, "shop_stg.bucketed", mode="overwrite", bucket_by=(4, ["product_id"]))
    t = spark.table("shop_stg.bucketed")
    plan = t.groupBy("product_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_load_typed_parquet_declared_schema(spark):
    df = load_typed(spark, table_path("/root/testdata/sf0.001", "part"), TEST_PART)
    assert df.schema == TEST_PART
    assert df.count() == 200


def test_load_typed_csv_failfast(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("product_id,brand\n1,A\n2,B\n")
    schema = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("brand", T.StringType())])
    assert load_typed(spark, str(good), schema, fmt="csv").count() == 2
    bad = tmp_path / "bad.csv"
    bad.write_text("product_id,brand\nxx,A\n")
    for read in (lambda df: df.collect(), lambda df: df.select("brand").collect(), lambda df: df.count()):
        with pytest.raises(Exception):
            read(load_typed(spark, str(bad), schema, fmt="csv"))


def test_csv_columns_are_checked_by_name(spark, tmp_path):
    file = tmp_path / "swapped.csv"
    file.write_text("last_name,first_name\nLee,Ann\n")
    schema = T.StructType([T.StructField("first_name", T.StringType()), T.StructField("last_name", T.StringType())])
    with pytest.raises(Exception):
        load_typed(spark, str(file), schema, fmt="csv").collect()


def test_parquet_columns_are_checked_by_name_and_type(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "a", 2.0)], "product_id long, brand string, cost double").write.parquet(path)
    assert file_columns(spark, path) == {"product_id": "INT64", "brand": "BINARY", "cost": "DOUBLE"}
    for name, kind in (("brnd", T.StringType()), ("brand", T.LongType()), ("product_id", T.IntegerType())):
        with pytest.raises(ValueError, match=name):
            load_typed(spark, path, T.StructType([T.StructField(name, kind)]))
    wide = T.StructType([T.StructField("cost", T.DoubleType())])
    assert load_typed(spark, path, wide).first().cost == 2.0
    with pytest.raises(Exception):
        load_typed(spark, str(tmp_path / "gone.parquet"), wide)


def test_a_later_run_sees_new_files(spark, tmp_path):
    from velocart.plans.registry import QUERIES

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    total = lambda: sum(r.row_count for r in QUERIES["agg_count"](spark, str(tmp_path)).collect())
    assert total() == 1500
    orders.write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert total() == 3000


def test_keep_first_in_file_order_over_many_files(spark, tmp_path):
    """Numbers in names count by value: part-2 comes before part-10. An older file comes first."""
    import os

    from velocart.operators import FILE_ORDER

    folder = tmp_path / "p.parquet"
    folder.mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    for n in (10, 2, 100000, 33):
        file = str(folder / f"part-{n}.parquet")
        pq.write_table(pa.table({"product_id": [1, n], "brand": [f"b{n}", "x"]}), file)
        os.utime(file, (1_000_000, 1_000_000))
    read = lambda: keep_first(spark.read.parquet(str(folder)), "product_id", FILE_ORDER)
    assert {r.product_id: r.brand for r in read().collect()}[1] == "b2"
    os.utime(str(folder / "part-100000.parquet"), (900_000, 900_000))
    assert {r.product_id: r.brand for r in read().collect()}[1] == "b100000"
    with pytest.raises(ValueError, match="import sequence"):
        keep_first(spark.read.parquet(str(folder)).distinct(), "product_id", FILE_ORDER)


def _lines(fmt, rows):
    if fmt == "csv":
        return "product_id,brand\n" + "".join(f"{i},{b}\n" for i, b in rows)
    return "".join(f'{{"product_id": {i}, "brand": "{b}"}}\n' for i, b in rows)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_keep_first_in_file_order_of_text_files(spark, tmp_path, fmt):
    """The same first records of text imports under any split size, however the rows are dealt to tasks."""
    import os
    import random

    from velocart.operators import FILE_ORDER

    rng, wanted = random.Random(3), {}
    schema = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("brand", T.StringType())])
    for n in (2, 10, 1):  # in the order of import: by time, then by the number in the name
        file = tmp_path / f"part-{n}.{fmt}"
        rows = [(rng.randrange(300), f"{n}-{i}-" + "x" * rng.randrange(40)) for i in range(1500)]
        file.write_text(_lines(fmt, rows))
        os.utime(file, (1_000_000 + (n == 1), 1_000_000 + (n == 1)))
        for i, b in rows:
            wanted.setdefault(i, b)
    for size in ("1g", "50000", "7000", "999"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = load_typed(spark, str(tmp_path), schema, fmt=fmt)
            assert df.rdd.getNumPartitions() > (0 if size == "1g" else 4)
            got = keep_first(df, "product_id", FILE_ORDER)
            assert {r.product_id: r.brand for r in got.collect()} == wanted, size
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_file_is_checked(spark, tmp_path):
    """A later file without a column, or with one of another type, raises; columns of all nulls and empty files don't."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "t.parquet"
    folder.mkdir()
    full = {"id": pa.array([1, 2], pa.int64()), "brand": ["a", "b"], "flag": [True, True], "cost": [1.0, None], "day": pa.array([0, 1], pa.date32())}
    schema = T.StructType.fromDDL("id long, brand string, flag boolean, cost double, day date")
    write = lambda name, columns: pq.write_table(pa.table(columns), str(folder / f"{name}.parquet"))
    write("a", full)
    write("b", {**full, "brand": pa.nulls(2, pa.string()), "flag": [False, False]})
    write("c", {**full, "flag": [True, False]})
    write("d", {k: pa.array(v).slice(0, 0) if not isinstance(v, pa.Array) else v.slice(0, 0) for k, v in full.items()})
    assert load_typed(spark, str(folder), schema).count() == 6
    assert missing_columns(spark, str(folder), schema).count() == 0
    for column in full:
        write("e", {k: v for k, v in full.items() if k != column})
        lacking = missing_columns(spark, str(folder), schema).collect()
        assert [(r.file.rsplit("/", 1)[1], r.column_name) for r in lacking] == [("e.parquet", column)]
        with pytest.raises(ValueError, match=f"e.parquet has no column {column}"):
            load_typed(spark, str(folder), schema)
    assert load_typed(spark, str(folder), schema, check="first").count() == 8
    write("e", {**full, "brand": pa.array([1, 2], pa.int64())})
    with pytest.raises(ValueError, match="different types"):
        load_typed(spark, str(folder), schema)
    write("e", {**full, "more": [1, 2]})
    assert load_typed(spark, str(folder), schema).count() == 8
    summary = scan_summary(spark, str(tmp_path), {"t": spark.read.schema(schema).parquet(str(folder))}).first()
    assert (summary.row_count, summary.column_count) == (8, 6)
    with pytest.raises(ValueError, match="has no column gone"):
        load_typed(spark, str(folder), T.StructType.fromDDL("id long, gone string"))
    with pytest.raises(ValueError, match="stored as bigint, declared int"):
        load_typed(spark, str(folder), T.StructType.fromDDL("id int"))


def test_stand_ins_of_all_types_differ(spark, tmp_path):
    """Each type's two stand-ins are read as such from a file without the column."""
    from velocart.sources.tables import _STAND_INS

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    schema = T.StructType.fromDDL("id long, " + ", ".join(f"c_{t} {t}" for t in _STAND_INS) + ", m decimal(12,2), whole decimal(3,3)")
    lacking = {r.column_name for r in missing_columns(spark, path, schema).collect()}
    assert lacking == {f.name for f in schema.fields} - {"id"}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    """Neither table nor folder; the second run works. A failed replacement leaves the old table."""
    import os

    from pyspark.sql import functions as F

    create_namespace(spark, "staged")
    root = next(r[1] for r in spark.sql("DESCRIBE NAMESPACE staged").collect() if r[0] == "Location").removeprefix("file:")
    names = lambda: sorted(os.listdir(root)) if os.path.isdir(root) else []
    good = spark.range(100).withColumn("k", F.col("id") % 5)
    bad = good.withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("no such value"))).otherwise(F.lit("x")))
    for kw in ({}, {"bucket_by": (4, ["k"])}, {"partition_by": ["k"]}):
        with pytest.raises(Exception, match="no such value"):
            save_table(bad, "staged.t", **kw)
        assert not spark.catalog.tableExists("staged.t") and names() == [] and spark.catalog.listTables("staged") == []
        save_table(good, "staged.t", **kw)
        assert spark.table("staged.t").count() == 100 and names() == ["t"]
        with pytest.raises(Exception, match="no such value"):
            save_table(bad, "staged.t", mode="overwrite", **kw)
        assert spark.table("staged.t").count() == 100 and names() == ["t"]
        with pytest.raises(AnalysisException, match="already exists"):
            save_table(good, "staged.t")
        save_table(spark.table("staged.t").filter("id < 10"), "staged.t", mode="overwrite", **kw)  # from itself
        assert spark.table("staged.t").count() == 10
        spark.sql("DROP TABLE staged.t")


def test_tables_are_not_kept_between_accesses(spark):
    t = SourceTables(spark, "/root/testdata/sf0.001")
    assert t.part is not t.part


def test_conform_to_product_schema(spark):
    df = spark.createDataFrame(
        [(1, "A", "Road", "high", "large", 10.5, 7.25)],
        "product_id int, brand string, product_line string, product_class string, product_size string, list_price double, standard_cost double",
    )
    out = conform(df, PRODUCT)
    assert out.schema == PRODUCT


def test_sizing_conf_for_a_large_cluster():
    from velocart.session import sizing_conf

    conf = sizing_conf(100 * 1024**4, 8000)  # 100 TiB over 1000 executors x 8 cores: 256 MiB partitions
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    small = sizing_conf(10 * 1024**2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert not any("bloomFilter" in k for k in small)
    bloom = sizing_conf(1024**4, 800, filtered_side_bytes=1024**3)
    assert bloom["spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"] == str(1024**3)
