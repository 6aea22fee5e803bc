"""Opening, counting, keeping and exporting instruction tables."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from sftprep.session import hadoop_path

FORMATS = ("parquet", "json", "csv")
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"'}


def load_split(
    spark: SparkSession,
    path: str,
    split: str = "train",
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Opens one split of a dataset.

    A table with a ``split`` column (a partition column when written by
    ``save_dataset``) is filtered to that split, so other partitions are not read. A
    table without one is a single-split dataset and holds ``train`` only.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {FORMATS}")
    if fmt != "parquet" and schema is None:
        raise ValueError(f"{fmt} input needs a schema: inferring one reads the data twice")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    df = reader.format(fmt).load(path)
    if "split" in df.columns:
        return df.where(F.col("split") == split).drop("split")
    if split != "train":
        raise ValueError(f"no split {split!r} in {path}: the table has no split column")
    return df


def count_records(df: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count("*").alias("n_rows"))


def count_while_reading(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """The same rows plus a counter filled by whatever action runs next.

    A job that writes the table gets its row count without a second pass.
    """
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("n_rows")), seen


def save_dataset(
    df: DataFrame, path: str, by: str | list[str] = "split", rows_per_file: int = 1_000_000
) -> None:
    """Keeps prepared rows as parquet, one folder per split."""
    keys = [by] if isinstance(by, str) else by
    df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)


# The layout of one kept entry. The manifest is written last.
MANIFEST, DATA = "manifest.json", "data"
_SLICE = 1 << 20
_NUMBERS = re.compile(r"#\d+L?|plan_id=\d+")


@dataclass(frozen=True)
class Kept:
    """Prepared rows, whether they were there before, and where they are."""

    rows: DataFrame
    hit: bool
    path: str


def source_digest(spark: SparkSession, sources: list[str]) -> dict:
    """Number, bytes and a digest of the files under ``sources`` by path, size and time of
    change. Spark lists the files and adds them up; their content is not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sources)
        .select("path", "length", F.unix_micros("modificationTime").alias("changed"))
    )
    key = F.xxhash64("path", "length", "changed")
    found = listed.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(key), F.lit(0)).alias("all"), F.sum(key.cast("decimal(20,0)")).cast("string").alias("sum"),
    ).first()
    return found.asDict()


def plan_text(df: DataFrame) -> str:
    """The analysed plan without the numbers that differ from one session to the next."""
    return _NUMBERS.sub("", df._jdf.queryExecution().analyzed().toString())


def reuse(
    df: DataFrame, root: str, sources: list[str], settings: dict | None = None, by: str | list[str] = "split"
) -> Kept:
    """``df`` as prepared rows under ``root``: read back when they are there, else written.

    An entry is named by the files under ``sources``, the plan of ``df`` and ``settings``
    (whatever else decides the rows: a seed, the version of a function). A file that is
    added, replaced or removed, another plan or another setting names another entry. An
    entry counts once its manifest is there, which is written after its rows, so what a
    run that was cut short has left is never read. Two runs that prepare the same entry at
    the same time write to folders of their own, and the last manifest holds. ``df`` must
    not depend on anything else, such as the time of day.
    """
    spark = df.sparkSession
    keys = [by] if isinstance(by, str) else list(by)
    files = source_digest(spark, sources)
    about = {"sources": files, "plan": plan_text(df), "settings": settings or {}, "by": keys, "schema": df.schema.json()}
    name = hashlib.sha256(json.dumps(about, sort_keys=True, default=str).encode()).hexdigest()
    entry = f"{root.rstrip('/')}/{name[:32]}"
    found = _manifest(spark, entry)
    hit = found is not None
    if not hit:
        data = f"{DATA}-{uuid.uuid4().hex}"
        save_dataset(df, f"{entry}/{data}", keys)
        found = {"data": data, "key": name, "sources": files, "settings": settings or {}}
        write_small(spark, f"{entry}/{MANIFEST}", json.dumps(found, default=str))
    path = f"{entry}/{found['data']}"
    return Kept(spark.read.schema(df.schema).parquet(path).select(*df.columns), hit, path)


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None when there is none."""
    files, named = hadoop_path(spark, path)
    if not files.exists(named):
        return None
    stream = files.open(named)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _manifest(spark: SparkSession, entry: str) -> dict | None:
    files, path = hadoop_path(spark, f"{entry}/{MANIFEST}")
    try:
        found = json.loads(read_small(spark, f"{entry}/{MANIFEST}") or "")
    except ValueError:  # absent or cut short
        return None
    return found if files.exists(path.getParent().suffix(f"/{found['data']}/_SUCCESS")) else None


def write_small(spark: SparkSession, path: str, data: str | bytes) -> None:
    """Writes a small file under another name first, so that it is there whole or not at all."""
    data = data.encode() if isinstance(data, str) else data
    files, final = hadoop_path(spark, path)
    draft = final.suffix(f"-{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        for at in range(0, len(data), _SLICE):
            stream.write(bytearray(data[at:at + _SLICE]))
    finally:
        stream.close()
    files.delete(final, False)
    if not files.rename(draft, final):
        raise OSError(f"could not write {path}")


STEPS_PER_FILE = 512


def export_shards(
    df: DataFrame,
    path: str,
    steps_per_file: int = STEPS_PER_FILE,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Writes one folder per worker, batches whole and in training order.

    A worker's rows are cut into stretches of ``steps_per_file`` steps and dealt by
    (worker, stretch), which needs no sample of the rows; a stretch is never split. Rows
    lie in training order within a file. ``finish`` is applied to rows where they are
    written, so what it adds (padding, labels) is never shuffled.
    """
    order = [c for c in ("worker", "step", "batch_id", "slot") if c in df.columns]
    stretch = F.expr(f"step div {steps_per_file}")
    dealt = df.repartition("worker", stretch).sortWithinPartitions(*order)
    (finish(dealt) if finish else dealt).write.partitionBy("worker").parquet(path)
