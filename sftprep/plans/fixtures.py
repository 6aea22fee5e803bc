"""Instruction tables derived from the plain chat and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sftprep.session import spread
from sftprep.sources.datasets import load_split

# A conversation's system text is copied this many times so that the turns of one
# very long conversation meet it in as many tasks.
TURN_SALTS = 8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_split(spark, f"{sf_dir}/documents.parquet")


def instruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rec_id, instruction, input, output``: each user turn directly answered.

    The next turn is found by joining on (conversation, turn), a unique key, so the
    length of a conversation does not matter.
    """
    turns = load_split(spark, f"{sf_dir}/conversations.parquet")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = (
        turns.where(F.col("role") == "system")
        .select("conv_id", F.col("text").alias("_system"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(TURN_SALTS - 1))))
    )
    return (
        asked.join(answered, ["conv_id", "turn"])
        .withColumn("_salt", F.pmod(F.col("turn"), F.lit(TURN_SALTS)).cast("int"))
        .join(system, ["conv_id", "_salt"], "left")
        .select(
            F.concat_ws(":", "conv_id", "turn").alias("rec_id"),
            "instruction",
            F.coalesce("_system", F.lit("")).alias("input"),
            "output",
        )
    )


def instruct_ctx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows under the names of the second schema family."""
    return instruct(spark, sf_dir).withColumnsRenamed({"input": "context", "output": "response"})


def doc_instruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as instruction rows: first line asks, the rest answers."""
    newline = F.instr("text", "\n")
    return spread(documents(spark, sf_dir)).select(
        F.col("doc_id").alias("rec_id"),
        F.when(newline == 0, F.col("text"))
        .otherwise(F.expr("substring(text, 1, instr(text, '\\n') - 1)"))
        .alias("instruction"),
        F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise("").alias("input"),
        F.when(newline == 0, "")
        .otherwise(F.expr("substring(text, instr(text, '\\n') + 1)"))
        .alias("output"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prompt_id, user_input``: questions to answer."""
    return load_split(spark, f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("prompt_id"), F.col("text").alias("user_input")
    )
