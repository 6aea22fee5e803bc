"""Session settings, reliable materialisation and size-checked small tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# A table may be shipped whole to every task only below both limits. Callers
# that exceed them must take their shuffle-join path instead.
MAX_SHIPPED_ROWS = 1 << 22
MAX_SHIPPED_BYTES = 128 << 20
# Rows of an Arrow batch when rows are whole texts or lists of their tokens.
BATCH_ROWS = 512


def build_session(master: str | None = None, app: str = "sftprep", **conf) -> SparkSession:
    """A session with the settings these jobs are tuned for.

    ``master`` is left to spark-submit when omitted.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.ui.enabled", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="sftprep-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


# Paths this process has handed out and not yet discarded.
_HANDED_OUT: list[str] = []
# The list of the thread that is inside ``passing``, if any.
_PASSING = threading.local()


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, inside the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    passing = getattr(_PASSING, "paths", None)
    (_HANDED_OUT if passing is None else passing).append(path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system names it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def discard_settled(spark: SparkSession) -> int:
    """Deletes what this process has written under ``new_path``, and says how many.

    Call it when a job's results have been written: tables that read a settled one can
    no longer be computed afterwards.
    """
    return _discard(spark, _HANDED_OUT)


def _discard(spark: SparkSession, paths: list[str]) -> int:
    gone = 0
    while paths:
        files, path = hadoop_path(spark, paths.pop())
        gone += bool(files.delete(path, True))
    return gone


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread settles inside are deleted at the end of the block.

    For jobs without an end, such as streams: each of their batches has its results
    written before the block ends.
    """
    before, paths = getattr(_PASSING, "paths", None), []
    _PASSING.paths = paths
    try:
        yield
    finally:
        _PASSING.paths = before
        _discard(spark, paths)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage there.

    The copy is a replicated file, so losing executors never loses it. A plain
    parquet table keeps column pruning and size statistics, which a checkpointed
    RDD would hide from the optimizer.
    """
    path = new_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than the cluster has cores.

    Real inputs have far more splits than cores and pass through untouched; a
    single small file would otherwise keep every later stage on one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores)


def fits(df: DataFrame, text_columns: tuple[str, ...] = ()) -> bool:
    """Whether ``df`` is under the limits; only a count and a byte sum are fetched."""
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text_columns), F.lit(0))
    rows, size = df.agg(
        F.count("*"), F.coalesce(F.sum((text_bytes + 8 * len(df.columns)).cast("long")), F.lit(0))
    ).first()
    return rows <= MAX_SHIPPED_ROWS and size <= MAX_SHIPPED_BYTES


def ship(df: DataFrame, text_columns: tuple[str, ...] = ()) -> pa.Table | None:
    """``df`` as an Arrow table on the driver, or None if it is over the limits."""
    return df.toArrow() if fits(df, text_columns) else None


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of a session, unless they are smaller already.

    Spark fills a batch by rows, 10,000 by default, and a worker holds one several times
    over; with whole texts that is most of its memory, and grows with a partition's rows.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
