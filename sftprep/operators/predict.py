"""Drawing continuations and answering prompt tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import NumericType, StringType, StructType

from sftprep.functions import uniform
from sftprep.operators.tokens import EOS_ID, Vocabulary, decode, encode, join_frequent
from sftprep.session import fits, settle, ship
from sftprep.sources.models import share_table

# Sampling settings and request defaults.
TOP_P = 0.7
TOP_K = 50
DEFAULT_TEMPERATURE = 1.0
DEFAULT_MAX_TOKENS = 100

# Stands for "any context the model has not seen".
ANY_CONTEXT = -1
# Decimal places kept before a threshold test: sums differ in their last bits with
# the order they are taken in.
PLACES = 9
STEPS_PER_SETTLE = 8


def next_probs(lm: DataFrame) -> DataFrame:
    """``(prev, next, p)`` from counts; a context has at most a vocabulary of rows."""
    context = Window.partitionBy("prev")
    return lm.select("prev", "next", (F.col("n") / F.sum("n").over(context)).alias("p"))


def with_temperature(probs: DataFrame, temperature: float) -> DataFrame:
    """Below 1 sharpens, above 1 flattens the probabilities of each context."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    flat = F.pow("p", F.lit(1.0 / temperature))
    return probs.withColumn("p", flat / F.sum(flat).over(Window.partitionBy("prev")))


def nucleus(probs: DataFrame, top_p: float = TOP_P, top_k: int = TOP_K) -> DataFrame:
    """``(prev, next, rank, p)``: the top k, then the shortest head that reaches top_p.

    ``p`` is renormalised over the kept head.
    """
    context = Window.partitionBy("prev")
    ordered = context.orderBy(F.desc("p"), "next")
    head = (
        probs.withColumn("rank", F.row_number().over(ordered))
        .where(F.col("rank") <= top_k)
        .withColumn("p", F.col("p") / F.sum("p").over(context))
    )
    by_rank = context.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("p").over(by_rank), F.lit(0.0))
    return (
        head.withColumn("_before", F.round(before, PLACES))
        .where(F.col("_before") < top_p)
        .withColumn("p", F.col("p") / F.sum("p").over(context))
        .select("prev", "next", "rank", "p")
    )


def candidates(
    model: DataFrame,
    top_k: int = TOP_K,
    weight: str = "n",
    overall: DataFrame | None = None,
) -> DataFrame:
    """``(prev, choices)``: the k likeliest tokens per context, likeliest first.

    ``weight`` is ``n`` for counts or ``p`` for an adapted model. Any temperature keeps
    the order, so one table serves every request. One extra row, ``ANY_CONTEXT``, holds
    the k likeliest tokens of the counts in ``overall``, the model's own by default.
    """
    alone = (model if overall is None else overall).groupBy("next").agg(F.sum("n").alias("w"))

    def top(rows: DataFrame) -> DataFrame:
        context = Window.partitionBy("prev")
        ordered = context.orderBy(F.desc("w"), "next")
        # Weights are relative to the likeliest token, so no power overflows.
        return (
            rows.withColumn("rank", F.row_number().over(ordered))
            .where(F.col("rank") <= top_k)
            .withColumn("w", F.col("w") / F.max("w").over(context))
            .groupBy("prev")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "next", "w"))).alias("choices"))
        )

    # Cut to k rows before they meet under one key.
    likeliest = alone.orderBy(F.desc("w"), "next").limit(top_k)
    return top(model.select("prev", "next", F.col(weight).alias("w"))).unionByName(
        top(likeliest.select(F.lit(ANY_CONTEXT).alias("prev"), "next", "w"))
    )


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


def _pick(choices: Column, temperature: Column, u: Column, top_p: float) -> Column:
    """The drawn token out of at most top-k choices, as one column expression."""
    running = F.aggregate(
        choices,
        F.array(F.lit(0.0)),
        lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + F.pow(c["w"], 1.0 / temperature))),
    )

    def passed(sums: Column, head: Column) -> Column:
        mass = F.get(sums, head)
        return F.size(F.filter(F.slice(sums, 2, head), lambda s: F.round(s / mass, PLACES) <= u))

    def place(sums: Column) -> Column:
        before = F.slice(sums, 1, F.size(sums) - 1)
        total = F.element_at(sums, -1)
        head = F.size(F.filter(before, lambda s: F.round(s / total, PLACES) < top_p))
        return _with(head, lambda h: F.least(passed(sums, h), h - 1))

    return F.get(choices, _with(running, place))["next"]


def _cumulated(choices: Column, temperature: float, top_p: float) -> Column:
    """The kept choices of a context, each with the upper end ``hi`` of its share of [0, 1)."""
    weights = F.transform(choices, lambda c: F.pow(c["w"], F.lit(1.0 / temperature)))
    sums = F.aggregate(
        weights, F.array(F.lit(0.0)), lambda a, w: F.concat(a, F.array(F.element_at(a, -1) + w))
    )

    def kept(sums: Column) -> Column:
        total = F.element_at(sums, -1)
        before = F.slice(sums, 1, F.size(sums) - 1)
        head = F.size(F.filter(before, lambda s: F.round(s / total, PLACES) < top_p))
        return _with(head, lambda h: F.transform(
            F.slice(choices, 1, h),
            lambda c, i: F.struct(
                c["next"].alias("next"), F.round(F.get(sums, i + 1) / F.get(sums, h), PLACES).alias("hi")
            ),
        ))

    return _with(sums, kept)


def _with_choices(ctx: DataFrame, table: DataFrame, key: str, via: str) -> DataFrame:
    """Joins each context row to its choices; unseen contexts get the overall row.

    A table under the shipping limits is broadcast. Beyond them it is joined, with copies
    of the contexts that many prompts share.
    """
    overall = table.where(F.col("prev") == ANY_CONTEXT).select("choices").scalar()
    seen = table.where(F.col("prev") != ANY_CONTEXT)
    if via != "join" and fits(table.select("prev", F.inline("choices"))):
        joined = ctx.join(F.broadcast(seen), "prev", "left")
    else:
        joined = join_frequent(ctx, seen, "prev", (key,), "left")
    return joined.withColumn("choices", F.coalesce("choices", overall))


def sample_next(
    ctx: DataFrame,
    table: DataFrame,
    key: str,
    seed,
    step: Column | str | int = 0,
    temperature: Column | float = DEFAULT_TEMPERATURE,
    top_p: float = TOP_P,
    via: str = "auto",
) -> DataFrame:
    """Adds ``next``: one token drawn for the context ``prev`` of each row.

    The draw depends on (seed, key, step) alone, so reruns repeat it. With one
    temperature for all, shares are summed up once per context and a draw is a lookup.
    """
    step = F.lit(step) if isinstance(step, int) else step
    if not isinstance(temperature, Column):
        table = table.withColumn("choices", _cumulated(F.col("choices"), float(temperature), top_p))
        below = F.size(F.filter("choices", lambda c: c["hi"] <= F.col("_u")))
        joined = _with_choices(ctx.withColumn("_u", uniform(seed, key, step)), table, key, via)
        picked = F.get("choices", F.least(below, F.size("choices") - 1))["next"]
        return joined.withColumn("next", picked).drop("choices", "_u")
    drawn = _pick(F.col("choices"), temperature, uniform(seed, key, step), top_p)
    return _with_choices(ctx, table, key, via).withColumn("next", drawn).drop("choices")


def _sampler(tables: Broadcast, seed, top_p: float):
    places = PLACES
    eos = EOS_ID

    @pandas_udf("array<int>")
    def draw(
        keys: pd.Series, last: pd.Series, temperature: pd.Series, limit: pd.Series
    ) -> pd.Series:
        from hashlib import md5

        place_of, tokens, weights, sizes = tables.value
        drawn: list[list[int]] = [[] for _ in range(len(keys))]
        names = keys.to_numpy()
        limits = limit.to_numpy()
        power = 1.0 / temperature.to_numpy()
        at = last.to_numpy().astype(np.int64)
        active = np.flatnonzero(limits > 0)
        step = 0
        while active.size:
            here = at[active]
            known = (here >= 0) & (here < len(place_of) - 1)
            row = place_of[np.where(known, here, -1)]
            w = np.where(weights[row] > 0, weights[row] ** power[active, None], 0.0)
            sums = np.cumsum(w, axis=1)
            before = np.hstack([np.zeros((len(row), 1)), sums[:, :-1]]) / sums[:, -1:]
            real = np.arange(w.shape[1]) < sizes[row][:, None]
            head = ((np.round(before, places) < top_p) & real).sum(axis=1)
            mass = sums[np.arange(len(row)), head - 1]
            inside = np.arange(w.shape[1]) < head[:, None]
            hashes = (md5(f"{seed}:{names[i]}:{step}".encode()).hexdigest() for i in active)
            u = np.fromiter((int(h[:8], 16) for h in hashes), float, len(active)) / 2.0**32
            passed = ((np.round(sums / mass[:, None], places) <= u[:, None]) & inside).sum(axis=1)
            token = tokens[row, np.minimum(passed, head - 1)]
            for i, t in zip(active, token):
                drawn[i].append(int(t))
            at[active] = token
            step += 1
            active = active[(token != eos) & (step < limits[active])]
        return pd.Series(drawn)

    return draw


def _ship_candidates(table: DataFrame):
    """Padded arrays by context for the sampler, or None when over the limits."""
    flat = table.select("prev", F.inline("choices"))
    arrow = ship(flat)
    if arrow is None:
        return None
    prev, rank, token, weight = (
        arrow.column(c).to_numpy() for c in ("prev", "rank", "next", "w")
    )
    contexts, row = np.unique(prev, return_inverse=True)
    width = int(rank.max()) if len(rank) else 1
    tokens = np.zeros((len(contexts), width), np.int32)
    weights = np.zeros((len(contexts), width))
    tokens[row, rank - 1] = token
    weights[row, rank - 1] = weight
    # Row of each context by token id; the last slot, and every gap, is "any context".
    any_row = int(np.searchsorted(contexts, ANY_CONTEXT))
    place_of = np.full(int(contexts.max(initial=0)) + 2, any_row)
    place_of[contexts[contexts >= 0]] = np.flatnonzero(contexts >= 0)
    sizes = np.bincount(row, minlength=len(contexts))
    return table.sparkSession.sparkContext.broadcast((place_of, tokens, weights, sizes))


def _generate_by_join(
    df: DataFrame, table: DataFrame, key: str, seed, top_p: float
) -> DataFrame:
    """Continuations by one join per step, for tables too large to ship.

    Settles every few steps: lineage stays short and a lost executor costs little.
    """
    table = settle(table)
    active = settle(
        df.select(
            key,
            "_last",
            "_temperature",
            "_limit",
            F.array().cast("array<int>").alias("_drawn"),
            (F.col("_limit") <= 0).alias("_done"),
        )
    )
    finished = active.where("_done")
    active = active.where("not _done")
    step = 0
    while not active.isEmpty():
        for _ in range(STEPS_PER_SETTLE):
            moved = sample_next(
                active.withColumnRenamed("_last", "prev"),
                table,
                key,
                seed,
                step,
                F.col("_temperature"),
                top_p,
                via="join",
            )
            going = ~F.col("_done")
            step += 1
            active = moved.select(
                key,
                F.when(going, F.col("next")).otherwise(F.col("prev")).alias("_last"),
                "_temperature",
                "_limit",
                F.when(going, F.concat("_drawn", F.array("next")))
                .otherwise(F.col("_drawn"))
                .alias("_drawn"),
                (
                    F.col("_done") | (F.col("next") == EOS_ID) | (F.col("_limit") <= step)
                ).alias("_done"),
            )
        active = settle(active)
        finished = finished.unionByName(active.where("_done"))
        active = active.where("not _done")
    return df.join(finished.select(key, "_drawn"), key)


def generate(
    prompts: DataFrame,
    table: DataFrame,
    key: str,
    seed=0,
    temperature: Column | float = DEFAULT_TEMPERATURE,
    max_tokens: Column | int = DEFAULT_MAX_TOKENS,
    top_p: float = TOP_P,
    ids: str = "input_ids",
    via: str = "auto",
) -> DataFrame:
    """Adds ``output_ids``: the prompt's ids followed by the drawn ones.

    Draws until the end token or ``max_tokens``. ``table`` comes from ``candidates``.
    """
    df = prompts.withColumns(
        {
            "_last": F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit(ANY_CONTEXT)),
            "_temperature": temperature
            if isinstance(temperature, Column)
            else F.lit(float(temperature)),
            "_limit": (
                max_tokens if isinstance(max_tokens, Column) else F.lit(int(max_tokens))
            ).cast("long"),
        }
    )
    shipped = None if via == "join" else _ship_candidates(table)
    if shipped is not None:
        draw = _sampler(shipped, seed, top_p)
        drawn = draw(F.col(key).cast("string"), "_last", "_temperature", "_limit")
        df = df.withColumn("_drawn", drawn)
    else:
        df = _generate_by_join(df, table, key, seed, top_p)
    return df.withColumn("output_ids", F.concat(ids, "_drawn")).select(
        *prompts.columns, "output_ids"
    )


def completion(
    df: DataFrame, include_prompt: bool = True, ids: str = "input_ids", out: str = "answer_ids"
) -> DataFrame:
    """Prompt and answer ids, or the answer alone."""
    if include_prompt:
        return df.withColumn(out, F.col("output_ids"))
    start = F.size(ids) + 1
    return df.withColumn(
        out, F.slice("output_ids", start, F.greatest(F.size("output_ids") - F.size(ids), F.lit(0)))
    )


def check_requests(df: DataFrame) -> DataFrame:
    """The typed request table: prompt string, temperature double, max_tokens long.

    An absent column takes its default; a null value does not and is reported in
    ``error`` instead, as is a temperature that cannot be used.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if "prompt" not in types:
        raise ValueError("requests need a column prompt")
    if not isinstance(types["prompt"], StringType):
        raise TypeError(f"prompt must be a string, not {types['prompt'].simpleString()}")
    defaults = {
        "temperature": ("double", DEFAULT_TEMPERATURE),
        "max_tokens": ("long", DEFAULT_MAX_TOKENS),
    }
    for name, (kind, default) in defaults.items():
        if name not in types:
            df = df.withColumn(name, F.lit(default).cast(kind))
        elif isinstance(types[name], NumericType):
            df = df.withColumn(name, F.col(name).cast(kind))
        else:
            raise TypeError(f"{name} must be a number, not {types[name].simpleString()}")
    return df.withColumn(
        "error",
        F.when(F.col("prompt").isNull(), "prompt is null")
        .when(F.col("temperature").isNull(), "temperature is null")
        .when(F.col("max_tokens").isNull(), "max_tokens is null")
        .when(
            ~(F.col("temperature") > 0) | F.isnan("temperature") | (F.col("temperature") == float("inf")),
            "temperature must be positive",
        )
        .when(F.col("max_tokens") < 1, "max_tokens must be at least 1"),
    )


def predict(
    df: DataFrame,
    vocab: Vocabulary,
    table: DataFrame,
    key: str,
    seed=0,
    top_p: float = TOP_P,
    include_prompt: bool = True,
    via: str = "auto",
) -> DataFrame:
    """Adds ``generated_text`` and ``error`` to every row of a request table."""
    checked = check_requests(df)
    good = F.col("error").isNull()
    asked = encode(checked, vocab, key, text="prompt", add_eos=False, via=via)
    answered = generate(
        asked,
        table,
        key,
        seed,
        F.when(good, F.col("temperature")).otherwise(F.lit(1.0)),
        F.when(good, F.col("max_tokens")).otherwise(F.lit(0)),
        top_p,
        via=via,
    )
    spelled = decode(
        completion(answered, include_prompt=False), vocab, key, "answer_ids", "_answer", via=via
    )
    text = F.concat("prompt", "_answer") if include_prompt else F.col("_answer")
    return spelled.withColumn("generated_text", F.when(good, text)).select(
        *checked.columns, "generated_text"
    )


def apply_rows(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """A caller's function over batches of rows, wherever the rows are."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield fn(part)

    return df.mapInPandas(batches, schema)


# What each Python worker has loaded, by the call that asked for it.
_LOADED: dict[str, object] = {}


def loaded(call: str, load: Callable[[], object]) -> object:
    """The worker's model for a call; workers refer to this function by name, and so
    keep what it has loaded."""
    if call not in _LOADED:
        _LOADED.clear()
        _LOADED[call] = load()
    return _LOADED[call]


def apply_model(
    df: DataFrame,
    load: Callable[[], object],
    fn: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
) -> DataFrame:
    """A caller's model over batches of rows, loaded once for each Python worker.

    A worker serves many tasks and keeps the model between them.
    """
    call = uuid.uuid4().hex

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(call, load)
        for part in parts:
            yield fn(model, part)

    return df.mapInPandas(batches, schema)


def likeliest(lm: DataFrame) -> DataFrame:
    """``prev, next``: the most frequent next token of each context, ties by token."""
    return lm.groupBy("prev").agg(F.min_by("next", F.struct(-F.col("n"), "next")).alias("next"))


def with_likeliest(
    df: DataFrame, best: DataFrame, ids: str = "input_ids", out: str = "next_id", via: str = "auto"
) -> DataFrame:
    """Adds the token that follows the last one of ``ids`` by ``best (prev, next)``, or null
    when there is no last token or it is no context of the table.

    A table under the shipping limits is one file per executor that its workers map; a
    larger one is joined, with frequent last tokens dealt over copies.
    """
    last = F.try_element_at(ids, F.lit(-1)).cast("int")
    load = None if via == "join" else share_table(best, sort_by="prev")
    if load is None:
        rows = settle(df.withColumn("_last", last).withColumn("_row", F.monotonically_increasing_id()))
        table = best.select(F.col("prev").alias("_last"), F.col("next").cast("int").alias(out))
        found = join_frequent(rows.select("_row", "_last"), table, "_last", by=("_row",))
        return rows.join(found.drop("_last"), "_row", "left").select(*df.columns, out)
    call = uuid.uuid4().hex

    # Only the last tokens go to Python and back.
    @arrow_udf("int")
    def following(lasts: pa.Array) -> pa.Array:
        model = loaded(call, load)
        if not model.num_rows:
            return pa.nulls(len(lasts), pa.int32())
        # Views of the mapped file, in the order of contexts.
        contexts, tokens = (model.column(c).chunk(0).to_numpy() for c in ("prev", "next"))
        asked = pc.fill_null(lasts, -1).to_numpy()
        at = np.minimum(np.searchsorted(contexts, asked), len(contexts) - 1)
        return pa.array(tokens[at], pa.int32(), mask=contexts[at] != asked)

    return df.withColumn(out, following(last))


def predict_with(
    df: DataFrame,
    load: Callable[[], object],
    fn: Callable[[object, pd.DataFrame], pd.Series],
) -> DataFrame:
    """Answers a request table with a caller's model: adds ``generated_text`` and ``error``.

    The table is checked as in ``check_requests``. ``fn`` gets the model and a batch of
    good requests (``prompt``, ``temperature``, ``max_tokens``) and returns their texts.
    Every row is answered, or says why it is not; an exception of ``fn`` falls back to
    single rows, so it costs only the rows that raise it.
    """
    checked = check_requests(df)

    def answer(model: object, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(generated_text=None)
        good = rows.index[rows["error"].isna()]
        asked = rows.loc[good, ["prompt", "temperature", "max_tokens"]]
        try:
            rows.loc[good, "generated_text"] = list(fn(model, asked)) if len(asked) else []
        except Exception:  # noqa: BLE001  the caller's function may raise anything
            for i in good:
                try:
                    rows.loc[i, "generated_text"] = list(fn(model, asked.loc[[i]]))[0]
                except Exception as failure:  # noqa: BLE001
                    rows.loc[i, "error"] = f"{type(failure).__name__}: {failure}"
        return rows

    schema = StructType([*checked.schema.fields]).add("generated_text", StringType())
    return apply_model(checked, load, answer, schema)
