"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratify.llm import (byte_bpe, chat_format, decontamination, exact_dedup, fill_in_middle, language_id, line_dedup,
                        minhash_dedup, quality_rules, secret_scan, source_mixing, token_alignment, token_counts)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_documents(spark, sf_dir))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(_documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(_documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixing(_documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_documents(spark, sf_dir)).drop("n_lost_words")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_figures(_documents(spark, sf_dir))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_figures(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_figures(_documents(spark, sf_dir))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fim_digests(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_formatting, op2_token_counts, op3_minhash_near_dedup, op4_language_id,
                            op5_secret_scans, op6_byte_bpe, op7_exact_dedup, op8_source_mixing, op9_quality_rules,
                            op10_line_dedup, op11_decontamination, op12_token_alignment, op13_fill_in_middle)}
