"""A corpus made ready for training: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. ``run`` writes what a stage keeps as Parquet and hands the
reread table to the next one. A stage that drops rows names their ids; rows without an
id are never dropped by id, and rows that repeat an id share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sftprep.llm.exact import exact_duplicates
from sftprep.llm.language import held_out_languages
from sftprep.llm.minhash import near_duplicates
from sftprep.llm.mixing import mixed
from sftprep.llm.store import keep
from sftprep.llm.transducer import decode, encode


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are in no language: null texts and texts without letters.

    A text with letters stays, also when no language can be learned from the table.
    """
    return _without(docs, held_out_languages(docs).where("not lettered"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of equal texts."""
    return _without(docs, exact_duplicates(docs).where("not kept"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of linked documents."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics have their target weights."""
    return _without(docs, mixed(docs).where("not kept"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids, exact``: piece ids, and whether they spell the text."""
    texts = docs.select("doc_id", "source", "lang", "text")
    return decode(encode(texts)).select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("mixing", mixing),
    ("SentencePiece encoding", sentencepiece_encoding),
]

# Nearest prototypes, raking and shortest paths have no SQL; tests hold each stage
# against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
