"""One query per corpus operator, over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sftprep.llm import (
    balls, exact, fingerprints, html, katz, language, lines, minhash, mixing, quality, substrings, transducer, trie,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_copies", "n_near", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.held_out_scores(_documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(_documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.held_out_quality(_documents(spark, sf_dir), labels)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats_removed(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_languages(_documents(spark, sf_dir)).select(
        "doc_id", "lang_pred", "score", "held_out"
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balls.ranked(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_katz_backoff": op3_katz_backoff,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_html_extraction": op12_html_extraction,
    "op13_conversation_trie": op13_conversation_trie,
}
