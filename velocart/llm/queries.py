"""The registered queries of the training-data operators: thin bindings to the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velocart.llm import class_lm, exact_dedup, filter_audit, html_extract, hyper_minhash, mixing, ngram_join, packing, quality_rules, substring_dedup, token_alignment, token_files, toxicity
from velocart.llm.store import new_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from labelled rows whose fold of three isn't 1."""
    labels = labels.select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit(docs, labels, fold("doc_id", 3) != 1)


@register
def op1_toxicity(spark, sf_dir):
    """All documents scored by the model learned from two of three folds of ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        F.col("toxic").cast("int").alias("predicted"),
    )


@register
def op2_html_extract(spark, sf_dir):
    """Main text of all pages."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register
def op3_exact_dedup(spark, sf_dir):
    """Copies equal up to the case of A-Z; the largest doc_id of a group stays."""
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).drop("file", "row")


SQL["op3_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


@register
def op4_ngram_join(spark, sf_dir):
    """Near-copy components of all documents at a Jaccard similarity of 0.75 of 5-word shingles."""
    return ngram_join.join(table(spark, sf_dir, "documents"), percent=75).drop("component", "file", "row")


SQL["op4_ngram_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i)
  WHERE len(w) > 0
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""


@register
def op5_token_files(spark, sf_dir):
    """Token files of all documents, written, read back and digested."""
    path = new_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return token_files.digests(token_files.read_token_files(spark, path))


@register
def op6_class_lm(spark, sf_dir):
    """All documents scored by the class model of nine of ten folds."""
    scored = class_lm.evaluate(table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    held_out = (fold("doc_id", 10) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op7_packing(spark, sf_dir):
    """All documents packed into sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, size=1024)


@register
def op8_substring_dedup(spark, sf_dir):
    """All documents without the words of repeated windows of 35 words."""
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept_text")


SQL["op8_substring_dedup"] = """
WITH texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS words
  FROM texts, unnest(range(1, len(w) - 33)) AS u(i)
  WHERE len(w) >= 35
),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY words) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM repeated, range(35) AS r(k)),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)
"""


@register
def op9_quality_rules(spark, sf_dir):
    """Base counts of all documents and the verdict of the list learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Tempered targets: small sources, languages and topics are raised.
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 0.8}


@register
def op10_mixing(spark, sf_dir):
    """All documents with the probability and the draw of their cell."""
    return mixing.mix(table(spark, sf_dir, "documents"), TEMPERATURE)


SQL["op10_mixing"] = mixing.mix_sql(TEMPERATURE)


@register
def op11_hyper_minhash(spark, sf_dir):
    """Near-copy components of all documents at a Jaccard similarity of 0.85 of 5-word shingles."""
    return hyper_minhash.join(table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


SQL["op11_hyper_minhash"] = f"""
WITH found AS ({SQL["op4_ngram_join"].replace("75 *", "85 *")})
SELECT *, doc_id = component_id AS kept FROM found
"""


@register
def op12_token_alignment(spark, sf_dir):
    """All documents by two tokenizers, aligned by bytes."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.Alignment(table(spark, sf_dir, "documents"), a, b).documents()


@register
def op13_filter_audit(spark, sf_dir):
    """Outcomes of five filters over all documents, by language, for all orders and steps."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op13_filter_audit"] = filter_audit.audit_sql()
