"""Mixing sources to target weights: token weights raked to marginals, then a draw.

Iterative proportional fitting scales the token weight of each (source, language, topic)
cell until the totals of every source, language and topic reach their targets. Each
document is then kept with the probability its cell's weight asks for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.functions import uniform
from sftprep.llm.store import keep, single_spaced

AXES = ("source", "lang", "topic")
# How far a share is moved towards evenness (1 leaves it), which part of
# the tokens is kept, and when raking has converged.
TEMPER = {"source": 0.8, "lang": 0.9, "topic": 1.0}
SHARE = 0.9
CLOSE = 1e-6
# Raking that gains less than this part of its error in a job cannot reach its targets.
_LEAST_GAIN = 0.001
_ROUNDS_A_JOB = 4
_SCALES = 64


def _occurrences(text: Column, *marks: str) -> Column:
    """How often any of some one-byte marks stands in a text."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(m), F.lit(""))) for m in marks), F.lit(0))


def token_count(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the number of words of a text; null has none. The text column is used up."""
    spaced = single_spaced(df, text).withColumn(text, F.trim(text))
    words = F.when(F.col(text) == "", 0).otherwise(_occurrences(F.col(text), " ") + 1)
    return spaced.withColumn(out, F.coalesce(words, F.lit(0)).cast("long")).drop(text)


def layout_topic(text: Column) -> Column:
    """A topic for corpora without one: how the text is laid out.

    ``table`` (cells between bars), ``code`` (braces or semicolons), ``notes`` (short
    lines), ``long`` and ``prose``.
    """
    text = F.coalesce(text, F.lit(""))
    size = F.octet_length(text)
    return (
        F.when(_occurrences(text, "|") * 40 > size, "table")
        .when(_occurrences(text, "{", "}", ";") * 40 > size, "code")
        .when(size < (_occurrences(text, "\n") + 1) * 60, "notes")
        .when(size > 8000, "long")
        .otherwise("prose")
    )


def _named(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def tempered_targets(cells: DataFrame, axis: str, power: float) -> DataFrame:
    """The target total of each value of an axis: its share to a power, all summing alike."""
    shares = cells.groupBy(axis).agg(F.sum("tokens").cast("double").alias("had"))
    raised = F.pow("had", F.lit(float(power)))
    whole = shares.agg(F.sum("had").alias("had"), F.sum(raised).alias("raised")).first()
    return shares.select(axis, (raised * F.lit(whole["had"]) / F.lit(whole["raised"])).alias("target"))


def _total(axis: str) -> Column:
    return F.sum("weight").over(Window.partitionBy(axis))


def _off(axis: str) -> Column:
    """How far the total of a cell's value lies from its target, as a part of the target."""
    return F.abs(_total(axis) - F.col(f"to_{axis}")) / F.greatest(F.col(f"to_{axis}"), F.lit(1.0))


def raked(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with ``weight``: scaled tokens whose totals reach the targets on every axis.

    ``cells`` has one row per occupied cell with ``tokens`` above 0. Targets name every
    value of their axis; a value that is not named is held at no tokens. Goes on until
    every total is within a millionth of its target, or until four rounds no longer bring
    the worst total 0.1 % nearer: then the targets contradict each other on the cells
    there are. ``off_<axis>`` says how far the total of a cell's value is from its target,
    as a part of the target.
    """
    for axis, target in targets.items():
        cells = cells.join(target.select(axis, F.col("target").alias(f"to_{axis}")), axis, "left")
    cells = keep(
        cells.withColumn("weight", F.col("tokens").cast("double")).na.fill(
            0.0, [f"to_{axis}" for axis in targets]
        )
    )
    worst = math.inf
    while worst > CLOSE:
        step = cells
        for _ in range(_ROUNDS_A_JOB):
            for axis in targets:
                scaled = F.col("weight") * F.col(f"to_{axis}") / _total(axis)
                step = step.withColumn("weight", F.when(_total(axis) > 0, scaled).otherwise(F.lit(0.0)))
        cells = keep(step)
        off = cells.select(F.greatest(*[_off(axis) for axis in targets], F.lit(0.0)).alias("off"))
        before, worst = worst, off.agg(F.max("off").alias("off")).first()["off"] or 0.0
        if worst > before * (1 - _LEAST_GAIN):
            break
    return keep(cells.select("*", *[_off(axis).alias(f"off_{axis}") for axis in targets]))


def calibrated(cells: DataFrame, share: float) -> DataFrame:
    """Cells with ``keep_probability``: ``min(1, scale * weight / tokens)``.

    The scale is found so that the expected tokens are ``share`` of all. Cells that
    would need more than their tokens are kept whole and the others make up for them.
    """
    low, high = 0.0, 1e9
    need = cells.agg((F.sum("tokens") * share).alias("need")).first()["need"]
    for _ in range(5):
        # Candidates lie closer together near the low end; each pass is one small sum.
        grid = [low + (high - low) * (i / _SCALES) ** 4 for i in range(_SCALES + 1)]
        sums = cells.agg(*[
            F.sum(F.least(F.col("tokens").cast("double"), F.col("weight") * s)).alias(f"s{i}")
            for i, s in enumerate(grid)
        ]).first()
        enough = [i for i in range(_SCALES + 1) if (sums[i] or 0.0) >= (need or 0.0)]
        at = enough[0] if enough else _SCALES
        low, high = grid[max(at - 1, 0)], grid[at]
    chance = F.least(F.lit(1.0), F.lit(high) * F.col("weight") / F.col("tokens"))
    return cells.withColumn("keep_probability", chance)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    targets: dict[str, DataFrame] | None = None,
    share: float = SHARE,
    seed: int = 5,
) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, weight, keep_probability, kept`` per row,
    and ``off_source, off_lang, off_topic``.

    ``weight`` is the raked weight of one token of the document's cell. ``off_<axis>`` is
    what raking left between the total of the document's value and its target, as a part
    of the target: near 0 unless the targets contradict each other. Targets default
    to tempered shares of the corpus; a caller may give a table ``(axis value, target)``
    per axis, with totals of the same scale. A null source, language or topic is a
    value of its own, written as an empty string. Documents without words have no
    tokens to weigh and are kept (probability 1); where no document of a cell has words,
    its ``off_<axis>`` are null. The draw is a hash of the seed and the
    id, so reruns agree and rows that repeat an id are drawn together.
    """
    topic = layout_topic(F.col(text_col)) if topic is None else topic
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"), topic.alias("topic"), F.col(text_col).alias("_text"),
    )
    listed = keep(
        token_count(named, "_text", "n_tokens").select("doc_id", *[_named(a).alias(a) for a in AXES], "n_tokens")
    )
    cells = keep(
        listed.where("n_tokens > 0").groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens"))
    )
    targets = targets or {a: tempered_targets(cells, a, TEMPER[a]) for a in AXES}
    weights = calibrated(raked(cells, targets), share).select(
        *AXES, (F.col("weight") / F.col("tokens")).alias("weight"), "keep_probability",
        *[f"off_{axis}" for axis in targets],
    )
    drawn = F.coalesce(uniform(seed, "doc_id"), F.lit(0.0)) < F.col("keep_probability")
    return (
        listed.join(weights, list(AXES), "left")
        .withColumn("keep_probability", F.when(F.col("n_tokens") > 0, F.col("keep_probability")).otherwise(1.0))
        .withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        .withColumn("kept", drawn)
    )
