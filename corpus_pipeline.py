"""Documents to token ids: each stage's rows are written as Parquet and are the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marginfold.llm import byte_bpe, decontaminate, language_id, pii, simhash
from marginfold.llm.queries import MULTI_RANKS, table
from marginfold.sources.scratch import written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a determinable or with an ambiguous language."""
    return language_id.of_clear_language(docs, language_id.train(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal values in the texts by pseudonyms."""
    replaced = pii.pseudonymise(docs).drop("pii_kinds")
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded bytes."""
    return byte_bpe.round_trip(docs, public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_stage),
    ("simhash", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", token_stage),
]

# Fitted classifiers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
