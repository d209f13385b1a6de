"""Thin queries over the driver's tables: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewake.llm import op1_binary, op2_html, op3_quality, op4_pii, op5_chat, op6_counts, op7_shards, op8_packing, op9_minhash, op10_decontaminate
from tidewake.llm.common import table


def op1_binary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_binary.token_digest(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_html.main_text(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = op3_quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_pii.find_personal_data(table(spark, sf_dir, "documents"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_chat.formatted(op5_chat.paired(table(spark, sf_dir, "conversations")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_shards.assign_shards(table(spark, sf_dir, "documents"))


def op8_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_packing.pack(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_binary_tokens, op2_main_text, op3_quality_rules, op4_personal_data, op5_preferences, op6_token_counts, op7_feistel_shards, op8_packed_sequences, op9_near_duplicates, op10_benchmark_leaks)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": op3_quality.SQL}
