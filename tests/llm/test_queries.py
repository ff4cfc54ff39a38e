import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LOWER
from tests.llm.test_dedup_and_join import expected_dedup, expected_join
from velocart.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM read_parquet('{DATA}/{name_}.parquet')")
    theirs = con.sql(SQL[name]).df()
    ours = QUERIES[name](spark, DATA).toPandas()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    rows = [sorted(map(str, f[columns].itertuples(index=False, name=None))) for f in (ours, theirs.astype(ours.dtypes[theirs.columns].to_dict()))]
    assert rows[0] == rows[1]


def test_every_query_covers_its_table(spark):
    for name, query in QUERIES.items():
        table = "pages" if name == "op2_html_extract" else "documents"
        if name in SQL:
            continue
        keys = "page_id" if table == "pages" else "doc_id"
        got = query(spark, DATA).select(keys).distinct().count()
        assert got == spark.read.parquet(f"{DATA}/{table}.parquet").count(), name


def test_pipeline_stages(spark, tmp_path):
    """Every stage against brute force on its own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert len(after) == docs.count() and all(before[d] == t for d, t in after.items())
        if name == "toxicity":
            gone = set(before) - set(after)
            assert gone and sum(labels.get(d, 1) for d in gone) >= 0.5 * len(gone)
        if name == "exact_dedup":
            assert set(after) == {d for d, row in expected_dedup(list(before.items())).items() if row[2]}
            assert len({(t or "").translate(LOWER) for t in after.values()}) == len(after)
        if name == "ngram_join":
            assert set(after) == {d for d, (_, smallest) in expected_join(list(before.items())).items() if d == smallest}
        if name == "mixing":
            assert 0.5 * len(before) < len(after) <= len(before)
        before = after


def test_pipeline_on_awkward_rows(spark, awkward, nothing, tmp_path):
    from velocart.llm import exact_dedup, ngram_join

    assert ngram_join.keep(exact_dedup.keep(awkward)).columns == awkward.columns
    docs = awkward.withColumn("source", F.col("key")).withColumn("lang", F.lit(None).cast("string"))
    counts = {"toxicity": [7], "exact_dedup": [3], "ngram_join": [3], "mixing": [0, 1, 2, 3]}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        ids = {r.doc_id for r in docs.collect()}
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == ids
            break
        assert docs.columns == before.columns and docs.count() in counts[name], name
        assert not docs.exceptAll(before).count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, DATA).count() == 0, name
