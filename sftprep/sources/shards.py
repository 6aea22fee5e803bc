"""Shards of a run that open at any step.

Rows lie in one folder per worker and stretch of steps, one file each, ordered by step.
Partition pruning leaves out the stretches before and after, and the steps each row
group's footer names leave out the rest of a file.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from sftprep.sources.datasets import STEPS_PER_FILE, read_small, write_small

# The layout of a folder of shards. The manifest is written last.
ROWS, INDEX, MANIFEST = "rows", "index", "shards.json"
ROW_GROUP_BYTES = 16 << 20
ORDER = ("step", "batch_id", "slot")


def write_shards(
    df: DataFrame,
    path: str,
    steps_per_file: int = STEPS_PER_FILE,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Writes rows with ``worker`` and ``step`` so that ``open_shards`` finds any step.

    A stretch of ``steps_per_file`` steps of one worker is one file. ``finish`` is applied
    where rows are written, as in ``export_shards``. Rows without a step or worker have no
    place in a run and are refused when they are written.
    """
    if steps_per_file < 1:
        raise ValueError(f"at least one step a file, not {steps_per_file}")
    if "stretch" in df.columns:
        raise ValueError("the column name stretch is taken by the layout")
    spark = df.sparkSession
    place = F.when(F.col("step").isNull() | F.col("worker").isNull(), F.raise_error("a row without step or worker"))
    df = df.withColumn("stretch", place.otherwise(F.expr(f"step div {steps_per_file}")).cast("long"))
    order = [c for c in ORDER if c in df.columns]
    dealt = df.repartition("worker", "stretch").sortWithinPartitions("worker", "stretch", *order)
    done = finish(dealt) if finish else dealt
    done.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("worker", "stretch").parquet(f"{path}/{ROWS}")
    found = (
        spark.read.schema(done.schema).parquet(f"{path}/{ROWS}")
        .groupBy("worker", "stretch", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count("*").alias("n_rows"))
    )
    found.write.parquet(f"{path}/{INDEX}")
    about = {"schema": done.schema.jsonValue(), "index": found.schema.jsonValue(), "steps_per_file": steps_per_file}
    write_small(spark, f"{path}/{MANIFEST}", json.dumps(about))


def _about(spark: SparkSession, path: str) -> dict:
    text = read_small(spark, f"{path}/{MANIFEST}")
    if text is None:
        raise ValueError(f"{path} holds no finished shards")
    return json.loads(text)


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: worker, stretch, first and last step, rows, and ``rows_before``, how
    many rows of the worker come before. Windows hold one row per file of a worker."""
    about = _about(spark, path)
    index = spark.read.schema(StructType.fromJson(about["index"])).parquet(f"{path}/{INDEX}")
    before = Window.partitionBy("worker").orderBy("stretch", "file").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("rows_before", F.coalesce(F.sum("n_rows").over(before), F.lit(0).cast("long")))


def open_shards(
    spark: SparkSession, path: str, first_step: int = 0, last_step: int | None = None, worker: int | None = None
) -> DataFrame:
    """The rows of steps ``first_step`` to ``last_step`` (both included; to the end if None),
    of one worker or of all. No file of another stretch or worker is read.

    Sort by ``step, batch_id, slot`` to iterate. A folder whose writing was cut short is
    refused; steps beyond the run give no rows.
    """
    about = _about(spark, path)
    every = about["steps_per_file"]
    rows = spark.read.schema(StructType.fromJson(about["schema"])).parquet(f"{path}/{ROWS}")
    rows = rows.where((F.col("stretch") >= first_step // every) & (F.col("step") >= first_step))
    if last_step is not None:
        rows = rows.where((F.col("stretch") <= last_step // every) & (F.col("step") <= last_step))
    if worker is not None:
        rows = rows.where(F.col("worker") == worker)
    return rows.drop("stretch")
