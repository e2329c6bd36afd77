"""One query per operator over its whole table, with production parameters, and its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordertide.llm import chat, glr, jaccard, linechunks, mixing, pii, postings, prefixfree, quality, superkmers, template, variants, warc
from ordertide.llm.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extracted(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tie", "n_near_items")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents")).drop("tie")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.identifiers(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("tie")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixfree.remove_repeats(table(spark, sf_dir, "documents")).drop("tie")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glr.report(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_quality_rules": op9_quality_rules,
    "op10_source_mixing": op10_source_mixing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_structure_repair": op12_structure_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
