"""Each operator as a query over its whole table, and in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marginfold.llm import (
    alignment,
    byte_bpe,
    conversations,
    decontaminate,
    fingerprints,
    html_text,
    language_id,
    pii,
    quality_mil,
    quality_rules,
    simhash,
    token_counts,
    token_files,
)
from marginfold.llm.sql import DECONTAMINATION, QUALITY_RULES
from marginfold.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kinds = F.array_join(F.array_sort(F.array_distinct("pii_kinds")), ",")
    return pii.pseudonymise(docs).select(
        "doc_id", "text", F.size("pii_kinds").cast("bigint").alias("n_pseudonyms"), kinds.alias("kinds")
    )


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_folder(spark)
    manifest = token_files.write_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), target)
    return token_files.read_tokens(manifest, target)


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return byte_bpe.round_trip(docs, public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    predicted = language_id.predict_language(docs, language_id.train(docs))
    return predicted.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return decontaminate.contamination(docs, table(spark, folder, "benchmark")).drop("doc")


def op9_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality_mil.score_quality(docs, quality_mil.train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        quality_mil.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_mil.THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
    )


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.alignment_counts(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.digests(conversations.repair(conversations.damage(table(spark, folder, "conversations"))))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.near_next_and_edited(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_simhash": op2_simhash,
        "op3_pii": op3_pii,
        "op4_token_files": op4_token_files,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_token_counts": op6_token_counts,
        "op7_language_id": op7_language_id,
        "op8_decontamination": op8_decontamination,
        "op9_quality_mil": op9_quality_mil,
        "op10_html_text": op10_html_text,
        "op11_alignment": op11_alignment,
        "op12_conversations": op12_conversations,
        "op13_fingerprints": op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": QUALITY_RULES, "op8_decontamination": DECONTAMINATION}
