"""End-to-end jobs: rendered splits, training shards, answers."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sftprep.operators.batches import (
    epochs,
    first_rows,
    length_batches,
    mega_factor,
    rank_batches,
    shard,
    step_cap,
    steps,
    train_test_split,
    unique_ids,
)
from sftprep.operators.lm import (
    adapt,
    best_checkpoint,
    checkpoint_counts,
    checkpoint_losses,
    fit_lm,
    metrics,
    run_log,
)
from sftprep.operators.predict import candidates, completion, generate
from sftprep.operators.prompts import (
    CONTEXT_RESPONSE,
    INPUT_OUTPUT,
    Fields,
    format_block,
    format_inline,
    inference_prompt,
)
from sftprep.operators.replay import MANY_INTERVALS, counted_run, replayed_log, replayed_losses, run_pairs
from sftprep.operators.tokens import (
    MAX_LENGTH,
    Vocabulary,
    causal_labels,
    decode,
    encode,
    pad_batch,
    tokenize,
)
from sftprep.session import settle
from sftprep.sources.datasets import export_shards
from sftprep.sources.models import StateLog


@dataclass(frozen=True)
class RunConfig:
    """Settings of a run that decide which rows meet in which step."""

    test_size: float = 0.1
    seed: int = 45
    batch: int = 4
    accum: int = 4
    world: int = 1
    n_epochs: int = 2
    max_steps: int | None = None  # 0 or below: no cap
    max_length: int | None = MAX_LENGTH
    by_length: bool = True
    inline: bool = False
    even: bool = False  # repeat leading batches until all workers have as many
    # Steps between saves, evaluations and log lines; 0 is once an epoch.
    save_steps: int = 500
    eval_steps: int = 200
    logging_steps: int = 100

    def steps_per_epoch(self, train_rows: int) -> int:
        return max(1, math.ceil(train_rows / (self.batch * self.accum * self.world)))

    def total_steps(self, train_rows: int) -> int:
        return step_cap(self.max_steps) or self.n_epochs * self.steps_per_epoch(train_rows)

    def cadence(self, train_rows: int, every: int) -> tuple[int, int]:
        """Steps per interval for a setting, and how many intervals the run has."""
        every = every if every > 0 else self.steps_per_epoch(train_rows)
        return every, math.ceil(self.total_steps(train_rows) / every)

    def epochs_read(self, train_rows: int) -> int:
        """A step cap overrides the number of epochs, in either direction."""
        cap = step_cap(self.max_steps)
        return self.n_epochs if cap is None else math.ceil(cap / self.steps_per_epoch(train_rows))


# Split, seed, batch and step settings of the three run kinds.
ADAPTER_RUN = RunConfig(max_steps=1000)
PARALLEL_ADAPTER_RUN = RunConfig(world=4, save_steps=0, eval_steps=0)
FULL_RUN = RunConfig(
    test_size=0.2, seed=68, batch=1, accum=1, world=4, max_steps=-1, by_length=False, inline=True,
    save_steps=100, eval_steps=100, logging_steps=10,
)


def rendered_split(
    rows: DataFrame,
    id_col: str,
    config: RunConfig = ADAPTER_RUN,
    fields: Fields = INPUT_OUTPUT,
) -> DataFrame:
    """Block-layout texts labelled train or test. Reads the rows, shuffles none."""
    return format_block(train_test_split(rows, id_col, config.test_size, config.seed), fields)


def rendered(rows: DataFrame, config: RunConfig, fields: Fields = CONTEXT_RESPONSE) -> DataFrame:
    """Texts in the run's layout: what its vocabulary should be counted on."""
    return (format_inline if config.inline else format_block)(rows, fields)


def tokenized_split(
    rows: DataFrame,
    id_col: str,
    vocab: Vocabulary,
    config: RunConfig = FULL_RUN,
    fields: Fields = CONTEXT_RESPONSE,
) -> DataFrame:
    """Texts in the run's layout as ids, labelled train or test."""
    split = train_test_split(rows, id_col, config.test_size, config.seed)
    return tokenize(rendered(split, config, fields), vocab, config.max_length, key=id_col)


def training_plan(rows: DataFrame, id_col: str, config: RunConfig) -> DataFrame:
    """Where each training row goes: epoch, batch, slot, width, step and worker.

    Works on ids and lengths alone, so every shuffle of planning is narrow. A run
    capped within its first epoch plans only the rows it will read.
    """
    lengths = rows.select(id_col, "length")
    n = unique_ids(lengths, id_col)
    n_epochs = config.epochs_read(n)
    mega = mega_factor(n, config.batch) if config.by_length else 1
    cap = step_cap(config.max_steps)
    if cap is not None and n_epochs == 1:
        megas = math.ceil(cap * config.accum * config.world / mega)
        # The order of epoch 0; whole mega-batches, so that batches come out the same.
        lengths = first_rows(lengths, id_col, f"{config.seed}:0", megas * mega * config.batch)
    ordered = epochs(lengths, id_col, n_epochs, config.seed)
    if config.by_length:
        batched = length_batches(ordered, id_col, config.batch, mega, group=["epoch"])
    else:
        batched = rank_batches(ordered, config.batch, group=["epoch"])
    placed = steps(
        batched,
        config.batch,
        config.accum,
        config.world,
        config.max_steps,
        config.steps_per_epoch(n),
    )
    return shard(placed, config.world, config.even, ["epoch"]).drop("length", "rank")


def placed_rows(rows: DataFrame, id_col: str, config: RunConfig) -> DataFrame:
    """Rows with their place in the run, not yet padded.

    ``rows`` should be a saved or settled table: planning reads two of its columns and
    the ids move in the join with the plan.
    """
    plan = training_plan(rows, id_col, config)
    return rows.select(id_col, "input_ids", "length").join(plan, id_col)


def padded(placed: DataFrame) -> DataFrame:
    """Padded and labelled rows; row by row, so it belongs after the last shuffle."""
    return causal_labels(pad_batch(placed, width="width"))


def training_shards(rows: DataFrame, id_col: str, config: RunConfig) -> DataFrame:
    """Padded, labelled rows with their place in the run."""
    return padded(placed_rows(rows, id_col, config))


def export_run(
    rows: DataFrame, id_col: str, config: RunConfig, path: str, write: Callable[..., None] = export_shards
) -> None:
    """Writes the shards of a run; ids move unpadded and are padded where they are written.

    With ``write=write_shards`` a run can be opened at any step (``open_shards``).
    """
    write(placed_rows(rows, id_col, config), path, finish=padded)


def placed_states(
    train: DataFrame, id_col: str, config: RunConfig, every: int | None = None
) -> tuple[DataFrame, int]:
    """Training rows with ``step`` and ``interval`` of the run's plan, once per epoch they
    are read in, and the number of intervals. The cadence is that of evaluation."""
    step, count = config.cadence(train.count(), config.eval_steps if every is None else every)
    plan = training_plan(train, id_col, config).select(id_col, "epoch", "step")
    return train.join(plan, id_col).withColumn("interval", F.expr(f"cast(step div {step} as int)")), count


def run_losses(placed: DataFrame, count: int, test: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``checkpoint_losses`` of ``placed_states``; a run of many intervals is read again
    instead of joined with its states."""
    if count >= MANY_INTERVALS:
        return replayed_losses(placed, count, test, counted=counted)
    return checkpoint_losses(settle(checkpoint_counts(placed)), count, test)


def run_counts(placed: DataFrame, count: int, counted: DataFrame | None = None) -> DataFrame:
    """``checkpoint_counts`` of ``placed_states``, counted in the way that suits their number."""
    if count >= MANY_INTERVALS:
        return run_pairs(counted_run(placed, count) if counted is None else counted)
    return checkpoint_counts(placed)


def logged_run(train: DataFrame, id_col: str, config: RunConfig) -> DataFrame:
    """The run's log, ``step, tokens, loss``: one row per ``logging_steps`` steps."""
    placed, count = placed_states(train, id_col, config, config.logging_steps)
    every, _ = config.cadence(train.count(), config.logging_steps)
    last = config.total_steps(train.count())
    if count >= MANY_INTERVALS:
        found = replayed_log(placed, count)
    else:
        found = run_log(settle(checkpoint_counts(placed))).where(F.col("interval") < count)
    return found.select(F.least((F.col("interval") + 1) * every, F.lit(last)).cast("long").alias("step"), "tokens", "loss")


def save_run(
    train: DataFrame, id_col: str, config: RunConfig, path: str, counted: DataFrame | None = None
) -> StateLog:
    """Saves the run's states every ``save_steps`` steps, each as what it adds.

    States that an earlier, unfinished call has saved are not computed again. ``counted`` is
    ``counted_run`` at that cadence, when it is there already.
    """
    placed, count = placed_states(train, id_col, config, config.save_steps)
    log = StateLog(train.sparkSession, path)
    there = set(log.saved())
    wanted = [c for c in range(1, count + 1) if c not in there]
    if wanted:
        log.append(run_counts(placed, count, counted), wanted, summed=True)
    return log


def best_saved(losses: DataFrame, config: RunConfig, train_rows: int) -> tuple[int, int | None]:
    """The checkpoint to keep, ``(save, evaluation)``: of the states that were both saved and
    evaluated the one of lowest loss, or the last save when no step was both."""
    evaluated, n = config.cadence(train_rows, config.eval_steps)
    saved, saves = config.cadence(train_rows, config.save_steps)
    last = config.total_steps(train_rows)
    step = {min(c * saved, last): c for c in range(1, saves + 1)}
    both = {c: step[min(c * evaluated, last)] for c in range(1, n + 1) if min(c * evaluated, last) in step}
    if not both:
        return saves, None
    best = best_checkpoint(losses.where(F.col("checkpoint").isin(list(both)))).first()["checkpoint"]
    return both[best], best


def evaluate_run(
    train: DataFrame, test: DataFrame, id_col: str, config: RunConfig, path: str
) -> tuple[DataFrame, DataFrame]:
    """The run's metrics per evaluation, and the best of its saved models.

    States are saved under ``path`` every ``save_steps`` steps and evaluated every
    ``eval_steps``; the best is read back from there (see ``best_saved``).
    """
    n = train.count()
    placed, count = placed_states(train, id_col, config)
    # A run that is saved where it is evaluated is counted once for both.
    both = config.cadence(n, config.save_steps) == config.cadence(n, config.eval_steps)
    counted = settle(counted_run(placed, count)) if both and count >= MANY_INTERVALS else None
    log = save_run(train, id_col, config, path, counted)
    losses = settle(run_losses(placed, count, test, counted))
    best, _ = best_saved(losses, config, n)
    return metrics(placed.select("interval", "step", "length"), losses), log.state(best)


def adapted_candidates(base: DataFrame, domain: DataFrame, weight: float) -> DataFrame:
    """What a base model adapted to a domain draws from, given the tokens of both.

    Contexts neither has seen fall back to the base's own token frequencies.
    """
    base_lm = fit_lm(base)
    mixed = adapt(base_lm, fit_lm(domain), weight)
    return candidates(mixed, weight="p", overall=base_lm)


# A request list is answered at length, without a nucleus cut.
REQUEST_TOKENS, REQUEST_TOP_P = 1024, 1.0


def answer_requests(
    requests: DataFrame,
    key: str,
    vocab: Vocabulary,
    table: DataFrame,
    seed=0,
    style: str = "chat",
    max_tokens: int = REQUEST_TOKENS,
) -> DataFrame:
    """Adds ``answer``, the drawn text alone, to each ``user_input``."""
    asked = encode(
        inference_prompt(requests, style), vocab, key, text="prompt", add_eos=False
    )
    drawn = generate(asked, table, key, seed, max_tokens=max_tokens, top_p=REQUEST_TOP_P)
    answers = completion(drawn, include_prompt=False)
    return decode(answers, vocab, key, ids="answer_ids", out="answer").select(
        *requests.columns, "answer"
    )
