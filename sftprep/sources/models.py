"""Keeping and opening model tables: one folder per checkpoint, a log of increments, or a
file that all workers of an executor share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from sftprep.session import hadoop_path, new_path, ship
from sftprep.sources.datasets import write_small

COUNTS = "prev int, next int, n long"
DONE = "_SUCCESS"
# Folders of a log, and of states that are saved as increments.
INCREMENT, FULL = "increment", "full"


def save_lm(states: DataFrame, path: str) -> None:
    """Writes ``(checkpoint, prev, next, n)`` with a folder for each checkpoint.

    States given as ``checkpoint_counts``, ``(prev, next, interval, n)``, are kept as what each
    adds to the one before: many states take the room of their new counts.
    """
    if "interval" in states.columns:
        states = states.select("prev", "next", "n", (F.col("interval") + 1).alias("checkpoint"))
        path = f"{path}/{INCREMENT}"
    states.write.partitionBy("checkpoint").parquet(path)


def saved_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """``(prev, next, interval, n)`` of states that were saved as increments, else None."""
    files, folder = hadoop_path(spark, f"{path}/{INCREMENT}")
    if not files.exists(folder):
        return None
    rows = spark.read.schema(f"{COUNTS}, checkpoint int").parquet(f"{path}/{INCREMENT}")
    return rows.select("prev", "next", (F.col("checkpoint") - 1).alias("interval"), "n")


def load_lm(spark: SparkSession, path: str, checkpoint: int) -> DataFrame:
    """One checkpoint's ``(prev, next, n)``; folders that it does not need are not read."""
    fresh = saved_counts(spark, path)
    if fresh is not None:
        return fresh.where(F.col("interval") < checkpoint).groupBy("prev", "next").agg(F.sum("n").alias("n"))
    states = spark.read.schema(f"{COUNTS}, checkpoint int").parquet(path)
    return states.where(F.col("checkpoint") == checkpoint).drop("checkpoint")


class StateLog:
    """Model states as a log: what each checkpoint adds to the one before.

    Checkpoint i is the sum of increments 1 to i. The log grows with new counts only, where
    full states grow with their number times their size. ``compact`` writes one full state;
    later states then read it and what came after. An increment or a full state counts once
    Spark has marked its folder as done, so a run that was cut short leaves no half state:
    the next one writes the same folder again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str, checkpoint: int) -> str:
        return f"{self.path}/{kind}/{checkpoint:08d}"

    def _done(self, kind: str) -> list[int]:
        """Checkpoints of which a whole folder is there; one entry per save of the run."""
        files, folder = hadoop_path(self.spark, f"{self.path}/{kind}")
        if not files.exists(folder):
            return []
        return sorted(self._numbers(files, folder.toString(), f"/*/{DONE}"))

    def _numbers(self, files, folder: str, below: str) -> list[int]:
        """Numbers in the places that match ``below`` in a folder; one call for all of them, for
        a run may have many states."""
        folder = re.sub(r"([\\{}\[\]*?^])", r"\\\1", folder)
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(folder + below))
        if found is None:
            return []
        jvm = self.spark._jvm
        listed = jvm.scala.runtime.ScalaRunTime.stringOf(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
        return [int(n) for n in re.findall(re.escape(below).replace(r"\*", r"(\d+)") + r"(?=, |\)$)", listed)]

    def saved(self) -> list[int]:
        """Checkpoints that can be opened: those without a gap before them."""
        done, full = set(self._done(INCREMENT)), set(self._done(FULL))
        last = max(full, default=0)
        while last + 1 in done:
            last += 1
        return sorted({c for c in done if c <= last} | full)

    def append(self, fresh: DataFrame, checkpoints: list[int], summed: bool = False) -> list[int]:
        """Saves increments of ``fresh (prev, next, interval, n)`` that are not saved yet, and
        tells which: interval i - 1 is what checkpoint i adds. With ``summed``, ``fresh`` has
        each pair of an interval once.

        One pass writes them all to a draft, and each then moves to its place and is marked
        as done. A checkpoint's rows may come in several files.
        """
        missing = sorted(set(checkpoints) - set(self._done(INCREMENT)))
        if not missing:
            return missing
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        wanted = self.spark.createDataFrame([(c - 1, c) for c in missing], "interval int, checkpoint int")
        part = fresh.join(F.broadcast(wanted), "interval")
        if not summed:
            part = part.groupBy("interval", "checkpoint", "prev", "next").agg(F.sum("n").alias("n"))
        part.select("prev", "next", "n", "checkpoint").write.partitionBy("checkpoint").parquet(draft)
        files, folder = hadoop_path(self.spark, f"{self.path}/{INCREMENT}")
        files.mkdirs(folder)
        there = set(self._numbers(files, folder.toString(), "/*"))
        drawn = set(self._numbers(files, draft, "/checkpoint=*"))
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        for checkpoint in missing:
            written, place = path_of(f"{draft}/checkpoint={checkpoint}"), path_of(self._folder(INCREMENT, checkpoint))
            if checkpoint in there:
                files.delete(place, True)
            # An interval without pairs has no rows, but it is saved.
            if not (files.rename(written, place) if checkpoint in drawn else files.mkdirs(place)):
                raise OSError(f"cannot save checkpoint {checkpoint} at {place}")
            files.create(place.suffix(f"/{DONE}")).close()
        files.delete(hadoop_path(self.spark, draft)[1], True)
        return missing

    def state(self, checkpoint: int) -> DataFrame:
        """``(prev, next, n)`` at a checkpoint; reads the last full state before it and the
        increments since. Checkpoint 0 is the empty model."""
        paths = self._needed(max([0, *(c for c in self._done(FULL) if c <= checkpoint)]), checkpoint)
        if not paths:
            return self.spark.createDataFrame([], COUNTS)
        parts = self.spark.read.schema(COUNTS).parquet(*paths)
        return parts if len(paths) == 1 else parts.groupBy("prev", "next").agg(F.sum("n").alias("n"))

    def _needed(self, full: int, checkpoint: int) -> list[str]:
        """Folders of the increments after a full state (0: none), and of that state."""
        wanted = range(full + 1, checkpoint + 1)
        absent = sorted(set(wanted) - set(self._done(INCREMENT)))
        if absent:
            raise ValueError(f"checkpoint {checkpoint} of {self.path} needs increments {absent}")
        return [*(self._folder(INCREMENT, c) for c in wanted), *([self._folder(FULL, full)] if full else [])]

    def counts(self) -> list[tuple[int, int, DataFrame]]:
        """``first, last, rows``: all states that can be opened, from one full state to the
        next, and ``rows (prev, next, interval, n)`` they add up from. Each increment after the
        first full state that is read, is read once; a full state counts as the interval
        of its checkpoint."""
        saved = set(self.saved())
        starts = sorted({0, *self._done(FULL)})
        out = []
        for start, after in zip(starts, [*starts[1:], None]):
            last = start
            while last + 1 in saved and last + 1 != after:
                last += 1
            if last == 0:
                continue
            rows = self.spark.read.schema(COUNTS).parquet(*self._needed(start, last))
            place = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]+$", 1).cast("int")
            out.append((max(start, 1), last, rows.select("prev", "next", (place - 1).alias("interval"), "n")))
        return out

    def compact(self, checkpoint: int) -> None:
        """Writes the full state of a checkpoint; the log stays as it is."""
        if checkpoint not in self._done(FULL):
            self.state(checkpoint).write.mode("overwrite").parquet(self._folder(FULL, checkpoint))


def mapped(name: str) -> pa.Table:
    """A shared file as an Arrow table whose columns lie in the file's pages."""
    return pa.ipc.open_file(pa.memory_map(SparkFiles.get(name))).read_all()


def share_table(
    df: DataFrame, sort_by: str | None = None, text_columns: tuple[str, ...] = ()
) -> Callable[[], pa.Table] | None:
    """``df`` as one file on each executor; returns what a worker calls to open it.

    Give the result to ``apply_model`` or ``predict_with`` as ``load``. A broadcast variable
    is unpacked by every Python worker; this file is mapped, so all workers of an executor
    read the same pages. Spark fetches it once per executor, also for executors that join
    later. None if the table is over the shipping limits: join it then. ``sort_by`` orders
    the rows, for binary search.
    """
    table = ship(df, text_columns)
    if table is None:
        return None
    if sort_by is not None:
        table = table.sort_by(sort_by)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as writer:
        # One piece a column, so that a column is a view of the file.
        writer.write_table(table.combine_chunks())
    spark, name = df.sparkSession, f"model-{uuid.uuid4().hex}.arrow"
    path = f"{new_path(spark, 'shared')}/{name}"
    write_small(spark, path, sink.getvalue().to_pybytes())
    spark.sparkContext.addFile(path)
    return lambda: mapped(name)
