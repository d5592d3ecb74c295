"""A training corpus from raw documents: five stages, each by one operator of ``tillroll.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of ``documents``.

1. language ID: a document without a letter, or whose language is unsure
   (posterior under ``LEAST_SURE``), is rejected; a missing lang is filled in.
2. SimHash near-dedup: of each group of linked documents the one with the
   smallest id stays (one without an id only where no other has one).
3. substring dedup: words that repeat a 50-word passage of a document with a
   smaller id go; a document that loses all its words goes.
4. mixing: every document as often as the mix takes it (0 to 3 times).
5. packing: token pieces with their place in sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.graph import cut
from tillroll.llm.language_id import NONE, language_id
from tillroll.llm.mixing import mix_documents
from tillroll.llm.packing import pack_documents
from tillroll.llm.simhash import simhash_dedup
from tillroll.llm.substring_dedup import substring_dedup

LEAST_SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = language_id(docs, F.lit(True))
    kept = named.where((F.col("lang_pred") != NONE) & (F.col("score") >= LEAST_SURE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup(docs, null_ids=True).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup(docs, keep_untouched=True).where("n_removed = 0 or n_removed < n_words")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
                                     .otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("pareto_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# models, hashes and tokenisers: no SQL form; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage kept is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
