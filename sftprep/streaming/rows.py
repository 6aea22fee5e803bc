"""Preparing instruction rows as they arrive.

Rendering, cutting, encoding, labels and pure row functions look at one row at a
time, so they run on a streaming table as they are. Splits, shuffles and batches
need the whole table and stay batch operators. Whatever joins with a table that is too
large to ship (a large vocabulary, a saved model) runs on each batch of arriving rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sftprep.operators.prompts import INPUT_OUTPUT, Fields, format_block
from sftprep.operators.tokens import MAX_LENGTH, Vocabulary, causal_labels, tokenize
from sftprep.session import passing

# Fixed value: names the folder of each batch.
BATCH = "arrived"


def read_rows(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """New files of a folder as a streaming table."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def prepare_rows(
    rows: DataFrame,
    vocab: Vocabulary,
    fields: Fields = INPUT_OUTPUT,
    max_length: int | None = MAX_LENGTH,
    via: str = "auto",
) -> DataFrame:
    """Rendered, tokenized and labelled rows; stateless, so no watermark is needed.

    A vocabulary over the shipping limits is joined, which a streaming table cannot do by
    itself: hand this function to ``write_batches`` then.
    """
    if rows.isStreaming and (via == "join" or vocab.shipped is None):
        raise ValueError("this vocabulary is joined: prepare each batch by write_batches")
    return causal_labels(tokenize(format_block(rows, fields), vocab, max_length, via=via))


def write_rows(df: DataFrame, path: str, progress: str | None = None, **trigger) -> StreamingQuery:
    """Appends to parquet exactly once per input file; ``trigger`` as in Spark.

    What has been read is noted in ``progress``, by default inside the output folder, so
    a later call with the same output goes on where the last one ended.
    """
    progress = progress or f"{path.rstrip('/')}/_progress"
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def write_batches(
    rows: DataFrame,
    path: str,
    prepare: Callable[[DataFrame], DataFrame],
    progress: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Appends ``prepare(batch)`` of each batch of arriving rows to parquet.

    ``prepare`` gets a plain table, so it may join, count and settle; what it settles is
    deleted when its batch is written. A batch has a folder of its own, ``arrived=<id>``,
    which is replaced when a batch is run again after a failure, so nothing is written
    twice. ``progress`` belongs to the output: with a new one, batches are numbered from 0
    again, so give a new output folder too.
    """
    progress = progress or f"{path.rstrip('/')}/_progress"

    def write(batch: DataFrame, batch_id: int) -> None:
        with passing(batch.sparkSession):
            prepare(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``write_batches`` has written so far, without the number of the batch."""
    return spark.read.schema(schema).parquet(path).drop(BATCH)
