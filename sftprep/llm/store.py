"""Intermediate tables of the corpus operators, and texts dealt into blocks.

Many operators need one exchange: blocks of documents ask the owners of keys about the
distinct keys they hold, and get one answer per key in the order asked. A key that a
third of all documents hold is asked about once per block, so no owner sees a hot key
more often than there are blocks, and texts never travel to the keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from sftprep.session import settle

# One Arrow table per group of a few megabytes keeps a Python worker
# well under a gigabyte, whatever the size of the corpus.
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
# A key that more rows than this hold may be shipped, and this many keys at most.
LIGHT_ROWS = 1000
HEAVY_KEYS = 1 << 15
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

MESSAGE = "block int, owner int, payload binary"


def keep(df: DataFrame) -> DataFrame:
    """Writes ``df`` into the shared folder, reads it back, and frees its shuffle files."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return settle(df)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def single_spaced(df: DataFrame, column: str, newlines: bool = True) -> DataFrame:
    """``column`` with each run of white space as one space; newlines stay when not wanted.

    Searching bytes is far cheaper than rewriting characters, so texts are rewritten
    only where a search finds something to do. One step per column keeps Spark from
    repeating a step in each place that reads it.
    """
    if newlines:
        df = df.withColumn(column, F.replace(column, F.lit("\n"), F.lit(" ")))
    odd = reduce(or_, [F.contains(column, F.lit(c)) for c in "\t\x0b\x0c\r"])
    df = df.withColumn(column, F.when(odd, F.translate(column, "\t\x0b\x0c\r", "    ")).otherwise(F.col(column)))
    double = F.contains(column, F.lit("  "))
    return df.withColumn(
        column, F.when(double, F.regexp_replace(column, " {2,}", " ")).otherwise(F.col(column))
    )


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id gives 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % divisor, F.lit(0))


def block_count(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks needed for the bytes there are; one narrow pass."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    return max(8, -(-size // block_bytes))


def blocked(texts: DataFrame, blocks: int) -> DataFrame:
    """Adds ``block``: rows are dealt by a hash of their id, so no source fills a block."""
    return texts.withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    )


def by_block(rows: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Runs ``work`` once per block."""
    return rows.groupBy("block").applyInArrow(work, schema)


def with_answers(
    rows: DataFrame,
    answers: DataFrame,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """Runs ``work(block rows, answers to the block)`` once per block."""
    return (
        rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(work, schema)
    )


def owners_of(keys: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each key of a sorted array: a range of the key space, so owners
    do not decrease and each owner's keys lie together."""
    return ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def slices(keys: np.ndarray, owners: int) -> list[tuple[int, int, int]]:
    """(owner, start, end) of each owner's part of a sorted array."""
    if not len(keys):
        return []
    own = owners_of(keys, owners)
    heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return list(zip(own[heads].tolist(), heads.tolist(), np.r_[heads[1:], len(keys)].tolist()))


def slices_by(batch: pa.RecordBatch, sizes: np.ndarray, limit: int, rows: int | None = None):
    """``batch`` in parts whose ``sizes`` sum to about ``limit``, one row at least and
    ``rows`` at most."""
    ends = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        to = to if rows is None else min(to, at + rows)
        yield batch.slice(at, to - at)
        at = to


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int | None = None):
    """``batch`` in parts whose ``column`` holds about ``limit`` bytes, one row at least.

    Arrow batches are cut by rows, and rows may be long: what a worker builds from one
    part is bounded by bytes.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    yield from slices_by(batch, sizes.astype(np.int64) + 16, limit, rows)


def with_one(rows: DataFrame, table: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Joins ``rows`` with the one row that ``table`` has per ``on``.

    Keys that a large share of the rows hold are looked up where the rows lie: there are
    at most ``HEAVY_KEYS`` of them, whatever the size of the rows. ``rows`` should be a
    kept table, for it is counted first.
    """
    limit = max(LIGHT_ROWS, rows.count() // HEAVY_KEYS)
    heavy = rows.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(on)
    shipped = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
    marked = rows.join(shipped, on, "left")
    few = table.join(F.broadcast(heavy), on, "left_semi")
    return (
        marked.where("_heavy").drop("_heavy").join(F.broadcast(few), on, how)
        .unionByName(marked.where("_heavy is null").drop("_heavy").join(table, on, how))
    )


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, first bytes of all values first: where high bytes are zero
    or alike, shuffle and file compression then leave almost nothing of them."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(payload: bytes, dtype, size: int, at: int = 0) -> np.ndarray:
    """``size`` values written by ``planes`` from byte ``at`` on."""
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(payload, np.uint8, size * width, at).reshape(width, size)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def messages(block: int, parts: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "block": pa.array([block] * len(parts), pa.int32()),
            "owner": pa.array([p[0] for p in parts], pa.int32()),
            "payload": pa.array([p[1] for p in parts], pa.binary()),
        }
    )


def asked(rows: DataFrame, answer: Callable[[pa.Table], pa.Table], schema: str = MESSAGE) -> DataFrame:
    """Runs ``answer`` once per owner over all that blocks have asked it."""
    return rows.groupBy("owner").applyInArrow(answer, schema)
