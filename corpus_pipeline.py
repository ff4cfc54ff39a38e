"""Corpus pipeline: from raw documents to packed training sequences.

Every stage works on all rows its predecessor kept; all but the last return
the columns they were given. The last returns the pieces of the sequences.

Defined results, as the stages' operators state them: a null text counts as
empty; rows without an id go through all stages and lose to a copy with an id;
of equal rows one stays after exact deduplication; documents without words are
linked with nothing; a null source or language counts as the value ``none``; without
labels of both classes no document is toxic; an empty table gives no rows at
any stage; further columns, whatever their names, stay up to packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from velocart.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from velocart.llm.queries import toxicity_model
from velocart.llm.store import ship_package, stored

#: Tempered targets, and the share of all tokens that is expected to stay.
TEMPERATURE = {"source": 0.9, "lang": 0.9, "topic": 0.9}
BUDGET = 0.9


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold; the model is learned from ``labels`` and these documents."""
    ship_package(spark)
    return toxicity.clean(docs, toxicity_model(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group equal up to the case of A-Z."""
    return exact_dedup.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    ship_package(spark)
    return ngram_join.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards tempered source, language and topic weights."""
    return mixing.keep(docs, TEMPERATURE, budget=BUDGET)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned stage and the token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
