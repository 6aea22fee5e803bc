"""A count-based causal language model over token tables.

Stands where a neural fine-tune would stand: it learns next-token probabilities,
combines a base with a domain set, and measures held-out loss per checkpoint. It is
not a neural model and its numbers do not resemble one.

A model is a table ``(prev, next, n)``. Tables keyed by one token have at most one
row per vocabulary entry, so no group here is larger than the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.operators.tokens import UNK_ID
from sftprep.session import settle, small_batches

# Share of the bigram estimate in a mixed probability; the rest is add-one unigram.
BIGRAM_SHARE = 0.7
# Tokens that a worker counts n-grams of at a time, and counts that it gives back at a time.
NGRAM_TOKENS, NGRAM_ROWS = 1 << 22, 1 << 16
ABSENT = -(1 << 40)  # stands for a null id; no id is as small


def bigrams(
    tokens: DataFrame, *keep: Column | str, ids: str = "input_ids", pad_id: int = UNK_ID
) -> DataFrame:
    """Adjacent pairs whose second token counts as a label.

    Pairs are cut out of each row's own array, so nothing is shuffled to find the
    previous token.
    """
    pairs = F.greatest(F.size(ids) - 1, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(ids, 1, pairs).alias("prev"), F.slice(ids, 2, pairs).alias("next")
    )
    return tokens.select(*keep, F.inline(zipped)).where(F.col("next") != pad_id)


def fit_lm(tokens: DataFrame, ids: str = "input_ids", pad_id: int = UNK_ID) -> DataFrame:
    """Next-token counts ``(prev, next, n)``."""
    return bigrams(tokens, ids=ids, pad_id=pad_id).groupBy("prev", "next").agg(
        F.count("*").alias("n")
    )


def _grouped(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of some columns of equal length, and how often each occurs. Rows that fit
    into a number are sorted as one."""
    lows = [int(c.min(initial=0)) for c in columns]
    bits = [(int(c.max(initial=0)) - low).bit_length() for c, low in zip(columns, lows)]
    if sum(bits) < 63:
        key = np.zeros(len(columns[0]), np.int64)
        for column, low, width in zip(columns, lows, bits):
            key = (key << width) | (column - low)
        key, n = np.unique(key, return_counts=True)
        found = []
        for low, width in zip(reversed(lows), reversed(bits)):
            found.append((key & ((1 << width) - 1)) + low)
            key = key >> width
        return found[::-1], n
    order = np.lexsort(columns)
    ordered = [c[order] for c in columns]
    heads = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in ordered], axis=0))) if len(order) else order
    return [c[heads] for c in ordered], np.diff(np.append(heads, len(order)))


def _part_ngrams(lists: pa.Array, order: int, pad_id: int, longest: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the labels of some rows by their contexts of each length or, with ``longest``,
    by their longest ones: ``length, next``, the tokens of the context, the nearest first, ``n``."""
    flat = lists.flatten().cast(pa.int64())
    ids = pc.fill_null(flat, ABSENT).to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    at = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    labels = np.flatnonzero((at > 0) & (ids != pad_id) & (ids != ABSENT))
    reach = order - 1
    for length in range(reach + 1):
        some = labels[at[labels] == length if longest and length < reach else at[labels] >= length]
        columns, n = _grouped([ids[some], *(ids[some - k] for k in range(1, length + 1))])
        if not len(n):
            continue
        known = [pa.array(c.astype(np.int32), mask=c == ABSENT) for c in columns]
        unknown = [pa.nulls(len(n), pa.int32())] * (reach - length)
        rows = [pa.array(np.full(len(n), length, np.int32)), *known, *unknown, pa.array(n)]
        whole = pa.RecordBatch.from_arrays(rows, ["length", "next", *_backs(order), "n"])
        for first in range(0, len(n), NGRAM_ROWS):
            yield whole.slice(first, NGRAM_ROWS)


def _backs(order: int) -> list[str]:
    """Names of the tokens of a context as columns, the nearest first: plain columns are grouped
    several times faster than arrays. A place has as many as ``length`` tells."""
    return [f"_back{k}" for k in range(1, order)]


def _counted_ngrams(tokens: DataFrame, order: int, ids: str, pad_id: int, longest: bool = False) -> DataFrame:
    """``length, next, _back1, ..., n``, counted where the rows lie, a bounded number of tokens at
    a time, and then summed."""
    small_batches(tokens.sparkSession)
    most = NGRAM_TOKENS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch.column(0))
            size += len(batch.column(0).flatten())
            if size >= most:
                yield from _part_ngrams(pa.concat_arrays(waiting), order, pad_id, longest)
                waiting, size = [], 0
        if waiting:
            yield from _part_ngrams(pa.concat_arrays(waiting), order, pad_id, longest)

    names = _backs(order)
    schema = ", ".join(f"{name} int" for name in ["length", "next", *names]) + ", n long"
    lists = tokens.select(F.col(ids).cast("array<int>").alias("ids")).where(F.size("ids") > 1)
    return lists.mapInArrow(count, schema).groupBy("length", *names, "next").agg(F.sum("n").alias("n"))


def _context(order: int) -> Column:
    """The context of a row of ``_counted_ngrams``, the nearest token last."""
    farthest_first = F.array(*[F.col(name) for name in reversed(_backs(order))]).cast("array<int>")
    return F.slice(farthest_first, order - F.col("length"), F.col("length")) if order > 1 else farthest_first


def _with_length(context: Column | str, length: Column) -> Column:
    """The last ``length`` tokens of a context."""
    return F.slice(context, F.size(context) - length + 1, length)


def fit_ngrams(tokens: DataFrame, order: int = 3, ids: str = "input_ids", pad_id: int = UNK_ID) -> DataFrame:
    """Counts ``(length, context, next, n)`` for contexts of 0 to ``order - 1`` tokens.

    Contexts of all lengths are counted in arrays in one pass over the tokens.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    counted = _counted_ngrams(tokens, order, ids, pad_id)
    return counted.select("length", _context(order).alias("context"), "next", "n")


def ngram_probs(model: DataFrame, asked: DataFrame, share: float = BIGRAM_SHARE) -> DataFrame:
    """Adds ``p`` to ``asked (context, next)``, whose rows are distinct.

    From the shortest context to the longest the model has seen,
    ``p = share * c(context, next) / c(context) + (1 - share) * p of one token less``, and
    ``p = (c(next) + 1) / (N + V + 1)`` without context. A context that was never seen
    leaves ``p`` as it is, so the probabilities of all known tokens and one unknown sum to
    one in every context.
    """
    each = asked.select(
        F.col("context").alias("asked"), "next", F.explode(F.sequence(F.lit(0), F.size("context"))).alias("length")
    ).withColumn("context", _with_length("asked", F.col("length")))
    totals = model.groupBy("length", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    overall = totals.where("length = 0").agg(
        F.coalesce(F.max("total"), F.lit(0)).alias("tokens"), F.coalesce(F.max("types"), F.lit(0)).alias("types")
    ).first()
    size = overall["tokens"] + overall["types"] + 1
    # Totals are looked up once per context, not once per asked token of it.
    wanted = each.select("length", "context").distinct().join(totals.drop("types"), ["length", "context"])
    counted = (
        each.join(model, ["length", "context", "next"], "left").join(wanted, ["length", "context"], "left")
        .groupBy("asked", "next").agg(F.array_sort(F.collect_list(F.struct("length", "n", "total"))).alias("steps"))
    )
    start = (F.coalesce(F.get("steps", F.lit(0))["n"], F.lit(0)) + 1).cast("double") / F.lit(float(size))

    def step(p: Column, s: Column) -> Column:
        mixed = share * F.coalesce(s["n"], F.lit(0)) / s["total"] + F.lit(1.0 - share) * p
        return F.when(s["total"].isNull(), p).otherwise(mixed)

    longer = F.slice("steps", 2, F.greatest(F.size("steps") - 1, F.lit(0)))
    return counted.select(F.col("asked").alias("context"), "next", F.aggregate(longer, start, step).alias("p"))


def ngram_loss(
    model: DataFrame, eval_tokens: DataFrame, order: int = 3, share: float = BIGRAM_SHARE,
    ids: str = "input_ids", pad_id: int = UNK_ID,
) -> DataFrame:
    """One row: mean negative log probability per held-out label under ``fit_ngrams``."""
    counted = _counted_ngrams(eval_tokens, order, ids, pad_id, longest=True)
    # Read three times below.
    held_out = settle(counted.select(_context(order).alias("context"), "next", F.col("n").alias("weight")))
    scored = ngram_probs(model, held_out.select("context", "next"), share).join(held_out, ["context", "next"])
    return scored.agg(
        (F.sum(-F.log("p") * F.col("weight")) / F.sum("weight")).alias("eval_loss"),
        F.sum("weight").alias("eval_tokens"),
    )


def adapt(base: DataFrame, domain: DataFrame, weight: float = 0.5) -> DataFrame:
    """Mixes a base and a domain model into ``(prev, next, p)``.

    A context only one of them has seen keeps that model's probabilities, so every
    context still sums to one. Both sides are already aggregated, so bringing all of
    a context together moves at most one row per vocabulary entry.
    """
    both = (
        base.select("prev", "next", F.col("n").alias("nb"))
        .join(domain.select("prev", "next", F.col("n").alias("nd")), ["prev", "next"], "full")
        .na.fill(0, ["nb", "nd"])
    )
    context = Window.partitionBy("prev")
    in_base, in_domain = F.sum("nb").over(context), F.sum("nd").over(context)
    share = (
        F.when(F.col("_b") == 0, F.lit(1.0))
        .when(F.col("_d") == 0, F.lit(0.0))
        .otherwise(F.lit(float(weight)))
    )
    # A missing context has share zero; the divisor only has to be non-zero then.
    return (
        both.withColumn("_b", in_base)
        .withColumn("_d", in_domain)
        .withColumn("_share", share)
        .select(
            "prev",
            "next",
            (
                F.col("_share") * F.col("nd") / F.greatest("_d", F.lit(1))
                + (1 - F.col("_share")) * F.col("nb") / F.greatest("_b", F.lit(1))
            ).alias("p"),
        )
    )


def checkpoint_counts(
    tokens: DataFrame,
    interval: Column | str = "interval",
    ids: str = "input_ids",
    pad_id: int = UNK_ID,
    by_interval: bool = False,
) -> DataFrame:
    """``(prev, next, interval, n)``: what each save interval adds to each pair.

    Checkpoint i is the sum of intervals 0 to i - 1. Pairs are counted map-side in the
    one pass over tokens; everything later reads these rows, so settle them. With
    ``by_interval``, for many short intervals, token rows are brought together by interval
    instead of their pairs: arrays of ids are a fraction of counted pairs.
    """
    interval = F.col(interval) if isinstance(interval, str) else interval
    if by_interval:
        tokens = tokens.select(interval.cast("int").alias("interval"), ids).repartition("interval")
        return bigrams(tokens, "interval", ids=ids, pad_id=pad_id).groupBy("prev", "next", "interval").agg(
            F.count("*").alias("n")
        )
    return (
        bigrams(tokens, interval.cast("int").alias("interval"), ids=ids, pad_id=pad_id)
        .groupBy("prev", "next", "interval")
        .agg(F.count("*").alias("n"))
    )


def _standing(fresh: DataFrame, n_checkpoints: int, *keys: str) -> DataFrame:
    """``(checkpoint, keys, n)``: running sums, one row per key and checkpoint it is in."""
    own = Window.partitionBy(*keys).orderBy("interval")
    until = F.least(F.coalesce(F.lead("interval").over(own), F.lit(n_checkpoints)), F.lit(n_checkpoints))
    return (
        fresh.where(F.col("interval") < n_checkpoints)
        .select(*keys, "interval", F.sum("n").over(own).alias("n"), until.alias("until"))
        .select(F.explode(F.sequence(F.col("interval") + 1, F.col("until"))).alias("checkpoint"), *keys, "n")
    )


def checkpoints(fresh: DataFrame, n_checkpoints: int) -> DataFrame:
    """Full model state at each checkpoint, ``(checkpoint, prev, next, n)``, from
    ``checkpoint_counts``."""
    return _standing(fresh, n_checkpoints, "prev", "next")


def checkpoint_sums(fresh: DataFrame, n_checkpoints: int, **weights: Column) -> DataFrame:
    """``(checkpoint, n_pairs, n, ...)``: how many pairs each full state has, their counts, and
    their counts times each of ``weights``, for ``fresh (prev, next, interval, n)``.

    A pair enters the states at its first interval and its counts only add up, so these are
    running sums over intervals; no state is put together. A state without pairs has no row.
    """
    fresh = fresh.where(F.col("interval") < n_checkpoints)
    added = fresh.groupBy("interval").agg(
        F.sum("n").alias("n"), *[F.sum(w * F.col("n")).alias(name) for name, w in weights.items()]
    )
    first = fresh.groupBy("prev", "next").agg(F.min("interval").alias("interval"))
    new = first.groupBy("interval").agg(F.count("*").alias("n_pairs"))
    points = fresh.sparkSession.range(1, n_checkpoints + 1).select(F.col("id").cast("int").alias("checkpoint"))
    by_point = points.withColumn("interval", F.col("checkpoint") - 1)
    # One row per checkpoint: the window without a key is bounded by the run settings.
    so_far = Window.orderBy("checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    each = by_point.join(added, "interval", "left").join(new, "interval", "left")
    return each.select(
        "checkpoint", *[F.sum(name).over(so_far).alias(name) for name in ("n_pairs", "n", *weights)]
    ).where("n_pairs > 0")


def checkpoint_losses(
    fresh: DataFrame,
    n_checkpoints: int,
    eval_tokens: DataFrame,
    bigram_share: float = BIGRAM_SHARE,
    ids: str = "input_ids",
    pad_id: int = UNK_ID,
) -> DataFrame:
    """``(checkpoint, eval_loss, eval_tokens)`` of the states in ``checkpoint_counts``.

    Held-out pairs are counted first, so a frequent pair is one row in every join, and
    only what they name is summed up. Rows grow with held-out pairs times checkpoints,
    never with full states.
    """
    fresh = fresh.where(F.col("interval") < n_checkpoints)
    held_out = (
        bigrams(eval_tokens, ids=ids, pad_id=pad_id)
        .groupBy("prev", "next")
        .agg(F.count("*").alias("weight"))
    )

    def standing(*keys: str) -> DataFrame:
        wanted = fresh.join(held_out.select(*keys).distinct(), list(keys), "left_semi")
        return _standing(wanted.groupBy(*keys, "interval").agg(F.sum("n").alias("n")), n_checkpoints, *keys)

    points = fresh.sparkSession.range(1, n_checkpoints + 1).select(F.col("id").cast("int").alias("checkpoint"))
    alone = fresh.groupBy("next", "interval").agg(F.sum("n").alias("n"))
    new_types = alone.groupBy("next").agg(F.min("interval").alias("interval")).groupBy("interval").agg(
        F.count("*").alias("types")
    )
    added = alone.groupBy("interval").agg(F.sum("n").alias("tokens")).join(new_types, "interval", "left")
    # One row per checkpoint: the window without a key is bounded by the run settings.
    so_far = Window.orderBy("checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    totals = points.join(added.withColumn("checkpoint", F.col("interval") + 1), "checkpoint", "left").select(
        "checkpoint",
        F.coalesce(F.sum("tokens").over(so_far), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("types").over(so_far), F.lit(0)).alias("types"),
    )
    every = F.explode(F.sequence(F.lit(1), F.lit(n_checkpoints))).alias("checkpoint")
    matched = (
        held_out.select("prev", "next", "weight", every)
        .join(standing("prev", "next").withColumnRenamed("n", "pairs"), ["checkpoint", "prev", "next"], "left")
        .join(standing("prev").withColumnRenamed("n", "in_context"), ["checkpoint", "prev"], "left")
        .join(standing("next").withColumnRenamed("n", "alone"), ["checkpoint", "next"], "left")
        .join(totals, "checkpoint")
    )
    pair = F.coalesce(F.try_divide("pairs", "in_context"), F.lit(0.0))
    single = (F.coalesce("alone", F.lit(0)) + 1) / (F.col("tokens") + F.col("types") + 1)
    p = F.lit(bigram_share) * pair + F.lit(1.0 - bigram_share) * single
    return matched.groupBy("checkpoint").agg(
        (F.sum(-F.log(p) * F.col("weight")) / F.sum("weight")).alias("eval_loss"),
        F.sum("weight").alias("eval_tokens"),
    )


def eval_loss(
    lm: DataFrame,
    eval_tokens: DataFrame,
    bigram_share: float = BIGRAM_SHARE,
    ids: str = "input_ids",
    pad_id: int = UNK_ID,
) -> DataFrame:
    """One row: mean negative log probability per held-out label."""
    fresh = lm.select("prev", "next", F.lit(0).alias("interval"), "n")
    return checkpoint_losses(fresh, 1, eval_tokens, bigram_share, ids, pad_id).select(
        "eval_loss", "eval_tokens"
    )


def best_checkpoint(losses: DataFrame) -> DataFrame:
    """The checkpoint of lowest loss; the earliest of equals."""
    return losses.agg(
        F.min(F.struct(F.round("eval_loss", 9).alias("eval_loss"), "checkpoint")).alias("_b")
    ).select("_b.checkpoint", "_b.eval_loss")


def metrics(rows: DataFrame, losses: DataFrame) -> DataFrame:
    """Per checkpoint: steps, rows and tokens seen so far, and held-out loss.

    ``rows`` needs only ``interval``, ``step`` and ``length``.
    """
    each = rows.groupBy((F.col("interval") + 1).alias("checkpoint")).agg(
        F.count("*").alias("_rows"), F.sum("length").alias("_tokens"), F.max("step").alias("_step")
    )
    # One row per checkpoint: the window without a key is bounded by the run settings.
    so_far = Window.orderBy("checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    return each.select(
        "checkpoint",
        F.sum("_rows").over(so_far).alias("rows_seen"),
        F.sum("_tokens").over(so_far).alias("tokens_seen"),
        (F.max("_step").over(so_far) + 1).alias("step"),
    ).join(losses.select("checkpoint", "eval_loss"), "checkpoint", "left")


def _before(counts: DataFrame, *keys: str) -> DataFrame:
    """Adds ``before``: the sum of ``n`` over earlier intervals of the same keys."""
    earlier = Window.partitionBy(*keys).orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def run_log(fresh: DataFrame, bigram_share: float = BIGRAM_SHARE) -> DataFrame:
    """``(interval, tokens, loss)``: each interval's own tokens scored by the state before it.

    This is the training loss a run reports as it goes: no token is scored by a model that
    has seen it. ``fresh`` is ``checkpoint_counts`` at the cadence of the log. Everything
    comes from counts per interval: what a pair, a context and a token had before are
    running sums over the intervals they occur in, so no state is ever written out.
    """
    pairs = _before(fresh.select("prev", "next", "interval", "n"), "prev", "next").withColumnRenamed("before", "pairs")
    contexts = _before(fresh.groupBy("prev", "interval").agg(F.sum("n").alias("n")), "prev")
    single = _before(fresh.groupBy("next", "interval").agg(F.sum("n").alias("n")), "next")
    # One row per interval: the window without a key is bounded by the run settings.
    so_far = Window.orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    totals = single.groupBy("interval").agg(
        F.sum("n").alias("tokens"), F.sum((F.col("before") == 0).cast("long")).alias("types")
    ).select(
        "interval",
        F.coalesce(F.sum("tokens").over(so_far), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("types").over(so_far), F.lit(0)).alias("types"),
    )
    scored = (
        pairs.join(contexts.select("prev", "interval", F.col("before").alias("in_context")), ["prev", "interval"])
        .join(single.select("next", "interval", F.col("before").alias("alone")), ["next", "interval"])
        .join(F.broadcast(totals), "interval")
    )
    pair = F.coalesce(F.try_divide("pairs", "in_context"), F.lit(0.0))
    one = (F.col("alone") + 1) / (F.col("tokens") + F.col("types") + 1)
    p = F.lit(bigram_share) * pair + F.lit(1.0 - bigram_share) * one
    return scored.groupBy("interval").agg(
        F.sum("n").alias("tokens"), (F.sum(-F.log(p) * F.col("n")) / F.sum("n")).alias("loss")
    )
