"""Seeded shuffle, exact split, epochs, length-grouped batches, steps and shards.

Row ids must be stable. Everything here orders rows by a hash of (seed, id), so the
same seed gives the same result on any cluster, and a source or group of copies that
makes up much of the data cannot make a bucket hot. A null or repeated id keeps all its
rows, but rows with one id are in no order among themselves; plans that are joined back
by id refuse them (``unique_ids``).
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.functions import shuffle_key

# Hex digits of the key that name a bucket. 16^4 buckets keep each bucket of a
# 100-billion-row table near a million rows and the bucket table at 65,536 rows.
BUCKET_DIGITS = 4
MEGA_BATCHES = 50


def _bucket(key: Column, digits: int) -> Column:
    return F.substring(key, 1, digits)


def _bucket_offsets(keys: DataFrame, digits: int, group: list[str]) -> DataFrame:
    """Rows per bucket, and rows in earlier buckets, of each group.

    At most 16^digits rows per group whatever the data size.
    """
    counts = keys.groupBy(*group, _bucket(F.col("_key"), digits).alias("_bucket")).agg(
        F.count("*").alias("_rows")
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *group,
        "_bucket",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("_total"),
    )


def shuffle_rank(
    df: DataFrame,
    id_col: str,
    seed,
    group: list[str] | None = None,
    out: str = "rank",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Adds the place 1..n of each row in a random total order fixed by the seed.

    Two levels instead of one global sort: rows are ranked inside hash buckets and
    shifted by the size of the buckets before. ``group`` columns get an order each.
    """
    group = group or []
    keyed = df.withColumn("_key", shuffle_key(seed, *group, id_col))
    offsets = _bucket_offsets(keyed.select(*group, "_key"), digits, group)
    offsets = offsets.select(*group, "_bucket", "_before")
    inside = Window.partitionBy(*group, "_bucket").orderBy("_key", id_col)
    # Up to 16^digits rows per group; Spark broadcasts the table only if it is small.
    placed = keyed.withColumn("_bucket", _bucket(F.col("_key"), digits)).withColumn(
        "_place", F.row_number().over(inside)
    )
    same = [placed[c].eqNullSafe(offsets[c]) for c in [*group, "_bucket"]]
    return (
        placed.join(offsets, reduce(and_, same))
        .drop(*[offsets[c] for c in [*group, "_bucket"]])
        .withColumn(out, F.col("_before") + F.col("_place"))
        .select(*df.columns, out)
    )


def unique_ids(df: DataFrame, id_col: str) -> int:
    """The number of rows, after making sure that each has an id of its own."""
    n, distinct = df.agg(F.count("*"), F.count_distinct(id_col)).first()
    if n != distinct:
        raise ValueError(f"{id_col} must be unique and not null: {n} rows have {distinct} ids")
    return n


def held_out_rows(n: int, test_size: float) -> int:
    """Rows of the test split: the share rounded up; training gets the rest."""
    return math.ceil(test_size * n)


def _keys_at(
    df: DataFrame, id_col: str, seed, places: Column, digits: int = BUCKET_DIGITS
) -> Column:
    """The (key, id) pairs found at some places of the shuffle order, in order.

    ``places`` is a short array and may use ``_total``. Bucket counts tell which
    bucket holds each place; only those buckets are ranked, from ids alone. Places
    outside 1..n are left out.
    """
    keys = df.select(shuffle_key(seed, id_col).alias("_key"), F.col(id_col).alias("_id"))
    edges = (
        _bucket_offsets(keys, digits, [])
        .withColumn("_want", F.explode(places))
        .where(
            (F.col("_before") < F.col("_want"))
            & (F.col("_want") <= F.col("_before") + F.col("_rows"))
        )
        .groupBy("_bucket")
        .agg(F.collect_list(F.col("_want") - F.col("_before")).alias("_nths"))
    )
    # A bucket holds n / 16^digits rows, and there are no more edges than places.
    inside = Window.partitionBy("_bucket").orderBy("_key", "_id")
    found = (
        keys.withColumn("_bucket", _bucket(F.col("_key"), digits))
        .join(F.broadcast(edges), "_bucket")
        .withColumn("_nth", F.row_number().over(inside).cast("long"))
        .where(F.array_contains("_nths", F.col("_nth")))
    )
    return found.agg(F.array_sort(F.collect_list(F.struct("_key", "_id")))).scalar()


def _own_key(seed, id_col: str) -> Column:
    return F.struct(shuffle_key(seed, id_col).alias("_key"), F.col(id_col).alias("_id"))


def train_test_split(
    df: DataFrame,
    id_col: str,
    test_size: float,
    seed,
    out: str = "split",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Adds ``split``: exactly ceil(test_size * n) rows are ``test``.

    The test rows are the first in shuffle order, so all that is needed is the key of
    the last of them. The data itself is labelled where it lies, with no shuffle.
    """
    n_test = F.ceil(F.lit(float(test_size)) * F.col("_total"))
    last = F.get(_keys_at(df, id_col, seed, F.array(n_test), digits), 0)
    is_test = _own_key(seed, id_col) <= last
    return df.withColumn(out, F.when(is_test, "test").otherwise("train"))


def order_intervals(
    df: DataFrame, id_col: str, seed, rows: int, count: int, out: str = "interval"
) -> DataFrame:
    """Adds the interval 0..count-1 a row falls in when shuffle order is cut every ``rows``.

    What a run has read by each of a few save points, without ranking the table.
    """
    if count == 1:
        return df.withColumn(out, F.lit(0))
    cuts = _keys_at(df, id_col, seed, F.array(*[F.lit(rows * i) for i in range(1, count)]))
    # Bound outside the lambda: a subquery may not stand inside one.
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("_own", _own_key(seed, id_col))
        .withColumn(out, F.size(F.filter("_cuts", lambda c: c < F.col("_own"))))
        .drop("_cuts", "_own")
    )


def first_rows(df: DataFrame, id_col: str, seed, rows: int) -> DataFrame:
    """Keeps the first ``rows`` in shuffle order: a filter by one key, no sort."""
    last = F.get(_keys_at(df, id_col, seed, F.array(F.lit(rows))), 0)
    # No such place means the table is shorter and all of it is wanted.
    return df.where(F.coalesce(_own_key(seed, id_col) <= last, F.lit(True)))


def in_shuffle_order(id_col: str, seed) -> list[Column]:
    """Sort keys that put rows in the order ``shuffle_rank`` numbers them."""
    return [shuffle_key(seed, id_col), F.col(id_col)]


def peek(df: DataFrame, n: int = 1, by: str | list[Column | str] = "rank") -> DataFrame:
    """The first rows in a stated order: a top-n, never a full sort."""
    keys = [by] if isinstance(by, str) else by
    return df.orderBy(*keys).limit(n)


def epochs(df: DataFrame, id_col: str, n_epochs: int, seed) -> DataFrame:
    """Repeats the rows once per epoch, each epoch in an order of its own.

    Give it ids and lengths only; join wide columns back once batches are planned.
    """
    if n_epochs < 1:
        raise ValueError(f"at least one epoch, not {n_epochs}")
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))))
    # Every 16 times more epochs take a digit less: the bucket table stays bounded.
    digits = BUCKET_DIGITS - math.ceil(math.log(max(n_epochs / 16, 1), 16))
    return shuffle_rank(repeated, id_col, seed, group=["epoch"], digits=max(digits, 1))


def mega_factor(n: int, batch: int) -> int:
    """Batches per mega-batch: 50, or fewer when the table is small."""
    return max(1, min(n // (batch * 4), MEGA_BATCHES))


def length_batches(
    df: DataFrame,
    id_col: str,
    batch: int,
    mega: int = MEGA_BATCHES,
    group: list[str] | None = None,
) -> DataFrame:
    """Adds ``batch_id``, ``slot`` and ``width`` so that like lengths share a batch.

    Needs ``rank`` and ``length``. Each run of ``batch * mega`` ranks is ordered by
    length and cut into batches, so a window never holds more rows than that. The
    width of a batch is found in the same partitioning, without another shuffle.
    """
    group = group or []
    inside = Window.partitionBy(*group, "_mega").orderBy(F.desc("length"), id_col)
    together = Window.partitionBy(*group, "_mega", "batch_id")
    return (
        df.withColumn("_mega", F.expr(f"(rank - 1) div {batch * mega}"))
        .withColumn("_place", F.row_number().over(inside) - 1)
        .withColumn("batch_id", F.expr(f"_mega * {mega} + _place div {batch}"))
        .withColumn("slot", F.expr(f"_place % {batch}"))
        .withColumn("width", F.max("length").over(together))
        .drop("_mega", "_place")
    )


def rank_batches(df: DataFrame, batch: int, group: list[str] | None = None) -> DataFrame:
    """The same columns with batches cut straight from the shuffle order."""
    together = Window.partitionBy(*(group or []), "batch_id")
    return (
        df.withColumn("batch_id", F.expr(f"(rank - 1) div {batch}"))
        .withColumn("slot", F.expr(f"cast((rank - 1) % {batch} as int)"))
        .withColumn("width", F.max("length").over(together))
    )


def step_cap(max_steps: int | None) -> int | None:
    """The step cap of a run; none at 0 or below, as trainers read -1."""
    return max_steps if max_steps is not None and max_steps > 0 else None


def steps(
    df: DataFrame,
    batch: int,
    accum: int = 1,
    world: int = 1,
    max_steps: int | None = None,
    steps_per_epoch: int | None = None,
) -> DataFrame:
    """Adds ``step``, the optimiser step a row's batch belongs to; -1 is no cap.

    Batches are dealt to ``world`` processes in turn and ``accum`` rounds make a
    step. Batches come from ``batch_id``, or from ``rank`` when there is none.
    With several epochs, ``steps_per_epoch`` numbers steps across them.
    """
    if "batch_id" not in df.columns:
        df = df.withColumn("batch_id", F.expr(f"(rank - 1) div {batch}"))
    step = F.expr(f"batch_id div {accum * world}")
    if "epoch" in df.columns and steps_per_epoch is not None:
        step = F.col("epoch") * F.lit(steps_per_epoch).cast("long") + step
    df = df.withColumn("step", step)
    cap = step_cap(max_steps)
    return df if cap is None else df.where(F.col("step") < cap)


def shard(df: DataFrame, world: int = 4, even: bool = False, group: list[str] | None = None) -> DataFrame:
    """Adds ``worker``, the process that trains on the row's batch.

    With ``even``, the first batches of a group are repeated at its end until every
    worker has the same number, so processes that train in step all reach the end.
    """
    if even:
        last = df.groupBy(*(group or [])).agg((F.max("batch_id") + 1).alias("_batches"))
        missing = F.pmod(-F.col("_batches"), F.lit(world))
        counted = df.join(last, group) if group else df.withColumn("_batches", last.scalar())
        # A table of fewer batches than workers repeats its batches in turn.
        again = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(world - 1)), lambda i: F.col("_batches") + i),
            lambda b: (b - F.col("_batches") < missing)
            & ((b - F.col("_batches")) % F.col("_batches") == F.col("batch_id")),
        )
        df = counted.withColumn("batch_id", F.explode(F.concat(F.array("batch_id"), again))).drop("_batches")
    return df.withColumn("worker", (F.col("batch_id") % world).cast("int"))


def run_plan(
    df: DataFrame,
    batch: int = 4,
    accum: int = 4,
    world: int = 1,
    n_epochs: int = 2,
    test_size: float = 0.1,
    max_steps: int | None = None,
) -> DataFrame:
    """One row: how many rows, batches and steps a run over ``df`` takes.

    A ``max_steps`` above 0 overrides the number of epochs; others are no cap.
    """
    if n_epochs < 1:
        raise ValueError(f"at least one epoch, not {n_epochs}")
    cap = step_cap(max_steps)
    planned = (
        df.agg(F.count("*").alias("n_rows"))
        .withColumn("test_rows", F.ceil(F.lit(float(test_size)) * F.col("n_rows")))
        .withColumn("train_rows", F.col("n_rows") - F.col("test_rows"))
        .withColumn("batches_per_epoch", F.ceil(F.col("train_rows") / F.lit(batch)))
        .withColumn(
            "steps_per_epoch", F.ceil(F.col("batches_per_epoch") / F.lit(accum * world))
        )
        .withColumn("epoch_steps", F.col("steps_per_epoch") * F.lit(n_epochs).cast("long"))
    )
    capped = F.col("epoch_steps") if cap is None else F.lit(cap).cast("long")
    return planned.withColumn("total_steps", capped).withColumn(
        "epochs_read", F.ceil(F.col("total_steps") / F.col("steps_per_epoch"))
    )
