"""A run read again in its own order, for figures that need the state at each of many steps.

Full states grow with their number times their size, and a row for each token costs more
than all sums over it. Here the rows of an interval are brought together and their pairs are
counted in arrays, where they lie; the counts then go to blocks of contexts, and a task goes
through all intervals of its block in order, with the counts it has seen so far. An interval
is a few steps, so its distinct pairs are bounded by the run settings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sftprep.operators.lm import BIGRAM_SHARE
from sftprep.operators.tokens import UNK_ID
from sftprep.session import small_batches

# From this many intervals on, a run is read again instead of joined with its states.
MANY_INTERVALS = 32
# Tokens that a worker reads before it counts them, and held-out pairs it scores at a time.
TOKENS, PAIRS = 1 << 21, 1 << 15
# Blocks of contexts, or one for each core: each block is given the counts of all single
# tokens, so there are no more of them than are of use.
STRETCHES = 24
# What a message counts: held-out pairs, tokens whose context is null, pairs of the run, and its
# single tokens.
HELD, LONE, PAIR, SINGLE = range(4)
MESSAGE = "block int, interval int, kind int, size int, shift int, names binary, counts binary"
SCORED = "interval int, n long, loss double"
WIDE = np.uint64(32)


def packed(values: np.ndarray) -> bytes:
    """Natural numbers, first bytes of all of them first, compressed."""
    values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    """What ``packed`` was given; its bytes tell how wide the numbers were."""
    raw = np.frombuffer(pa.input_stream(pa.py_buffer(data), compression="zstd").read(), np.uint8)
    width = len(raw) // max(size, 1)
    flat = np.ascontiguousarray(raw.reshape(width, size).T)
    return flat.view(f"u{width}").ravel().astype(np.uint64)


def _labels(lists: pa.Array, pad_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent ids of the same row whose second one counts as a label, and which of the first
    ones are known, that is not null."""
    flat = lists.flatten()
    valid = pc.is_valid(flat).to_numpy(zero_copy_only=False)
    ids = pc.fill_null(flat, pad_id).to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    counted = ids != pad_id
    counted[starts[starts < len(ids)]] = False
    second = np.flatnonzero(counted)
    return ids[second - 1], ids[second], valid[second - 1]


def _summed(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names in order, and the sums of their counts."""
    order = np.argsort(names, kind="stable")
    names, counts = names[order], counts[order]
    heads = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    return names[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def blocks_of(prev: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each context: a hash, so that frequent tokens do not lie together."""
    mixed = (prev.astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
    mixed = ((mixed ^ (mixed >> np.uint64(15))) * np.uint64(2246822519)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(blocks)) >> WIDE).astype(np.uint16 if blocks < 1 << 16 else np.int64)


class _Tally:
    """Counts of pairs, of single tokens and of tokens after a null, from labels put in."""

    def __init__(self):
        self.waiting, self.parts, self.size = [], [], 0

    def put(self, labels: tuple[np.ndarray, np.ndarray, np.ndarray], most: int) -> None:
        self.waiting.append(labels)
        self.size += len(labels[0])
        if self.size > most:
            self.count()

    def count(self) -> None:
        prev, following, known = map(np.concatenate, zip(*self.waiting))
        self.waiting, self.size = [], 0
        prev, following = prev.view(np.uint32), following.view(np.uint32)
        first, second = prev[known], following[known]
        if max(int(first.max(initial=0)), int(second.max(initial=0))) < 1 << 16:
            names, n = np.unique((first << np.uint32(16)) | second, return_counts=True)
            names = ((names.astype(np.uint64) >> np.uint64(16)) << WIDE) | (names & np.uint32(0xFFFF))
        else:
            names, n = np.unique((first.astype(np.uint64) << WIDE) | second, return_counts=True)
        singles, lone = (np.unique(x, return_counts=True) for x in (following, following[~known]))
        self.parts.append(((names, n), singles, lone))

    def sums(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.waiting:
            self.count()
        if len(self.parts) == 1:
            return list(self.parts[0])
        return [_summed(*map(np.concatenate, zip(*some))) for some in zip(*self.parts)]


def _messages(interval: int, tally: _Tally, blocks: int, held: bool) -> pa.RecordBatch:
    """The sums of an interval: pairs by block; tokens, which every block needs, to block -1."""
    (names, n), singles, lone = tally.sums()
    shift = 16 if not len(names) or (int(names[-1]) >> 48 == 0 and not (names & np.uint64(0xFFFF0000)).any()) else 32
    place = blocks_of(names >> WIDE, blocks)
    order = np.argsort(place, kind="stable")
    names, n = names[order], n[order]
    if shift == 16:
        names = ((names >> np.uint64(16)) | (names & np.uint64(0xFFFF))).astype(np.uint32)
    rows = []

    def add(block: int, kind: int, shift: int, some: np.ndarray, counts: np.ndarray) -> None:
        gaps = np.diff(some, prepend=some.dtype.type(0))
        rows.append((block, interval, kind, len(some), shift, packed(gaps), packed(counts)))

    for block, (a, b) in enumerate(pairwise([0, *np.cumsum(np.bincount(place, minlength=blocks)).tolist()])):
        if b > a:
            add(block, HELD if held else PAIR, shift, names[a:b], n[a:b])
    if len(singles[0]) and not held:
        add(-1, SINGLE, 0, *singles)
    if len(lone[0]):
        add(-1, LONE, 0, *lone)
    kinds_of = [pa.int32()] * 5 + [pa.binary()] * 2
    columns = [name.split()[0] for name in MESSAGE.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds_of)], columns
    )


def _counted(rows: DataFrame, blocks: int, pad_id: int, held: bool = False) -> DataFrame:
    """Messages of ``rows (interval, ids)``; neighbouring rows of an interval are counted at once."""
    most = TOKENS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tally = None, None
        for batch in batches:
            intervals, lists = batch.column(0).to_numpy(), batch.column(1)
            for a, b in _runs(intervals):
                if at != intervals[a]:
                    if tally is not None:
                        yield _messages(at, tally, blocks, held)
                    at, tally = int(intervals[a]), _Tally()
                tally.put(_labels(lists.slice(a, b - a), pad_id), most)
        if tally is not None:
            yield _messages(at, tally, blocks, held)

    return rows.select("interval", "ids").mapInArrow(count, MESSAGE)


def _runs(intervals: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of the same interval."""
    if len(intervals):
        yield from pairwise([0, *(np.flatnonzero(np.diff(intervals)) + 1).tolist(), len(intervals)])


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Names of a message, pairs as context and token of 32 bits each, and their counts."""
    names = np.cumsum(unpacked(row["names"], row["size"]), dtype=np.uint64)
    if row["shift"] == 16:
        names = ((names >> np.uint64(16)) << WIDE) | (names & np.uint64(0xFFFF))
    return names, unpacked(row["counts"], row["size"]).astype(np.int64)


def _in_order(messages: DataFrame, blocks: int, state: Callable[[], _Counts]) -> DataFrame:
    """``state`` of each block, fed with its messages interval by interval."""
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    block = F.explode(F.when(F.col("kind") == SINGLE, every).otherwise(F.array(F.greatest("block", F.lit(0)))))
    dealt = messages.withColumn("block", block).repartitionById(blocks, F.col("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at = state(), None
        told: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if at is not None and row["interval"] != at:
                    yield from model.step(at, told)
                    told = {}
                at = row["interval"]
                told.setdefault(row["kind"], []).append(_read(row))
        if at is not None:
            yield from model.step(at, told)
        yield from model.close()

    return dealt.sortWithinPartitions("interval").mapInArrow(run, SCORED)


class _Index:
    """A place for each name, in the order names came. What is new waits in a short sorted list,
    so that the long one is seldom put together anew."""

    def __init__(self):
        self.size = 0
        self.lists = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]

    def places(self, names: np.ndarray) -> np.ndarray:
        """Of distinct names in order; names without a place get one."""
        out = np.full(len(names), -1, np.int64)
        for known, places in self.lists:
            if len(known):
                at = np.minimum(np.searchsorted(known, names), len(known) - 1)
                out = np.where(known[at] == names, places[at], out)
        new = out < 0
        if new.any():
            out[new] = self.size + np.arange(new.sum())
            self.size += int(new.sum())
            self.lists[1] = self._merged(self.lists[1], (names[new], out[new]))
            if len(self.lists[1][0]) > 4096 + len(self.lists[0][0]) // 64:
                self.lists = [self._merged(*self.lists), (names[:0], out[:0])]
        return out

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        names = np.concatenate([a[0], b[0]])
        order = np.argsort(names, kind="stable")
        return names[order], np.concatenate([a[1], b[1]])[order]


def _grown(sums: np.ndarray, size: int) -> np.ndarray:
    """``sums`` with room for ``size`` names."""
    return sums if len(sums) >= size else np.append(sums, np.zeros(max(size, 2 * len(sums)) - len(sums)))


class _Counts:
    """Counts of single tokens so far; all blocks are told of all of them."""

    def __init__(self, share: float):
        self.share, self.total = share, 0.0
        self.singles, self.alone = _Index(), np.zeros(0)

    def told(self, told: dict[int, list], kind: int) -> tuple[np.ndarray, np.ndarray]:
        found = told.get(kind, [])
        if len(found) == 1:
            return found[0]
        return _summed(*map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def places(self, names: np.ndarray) -> np.ndarray:
        places = self.singles.places(names)
        self.alone = _grown(self.alone, self.singles.size)
        return places

    def add(self, places: np.ndarray, n: np.ndarray) -> None:
        """Tokens and types, together, are what estimates without context divide by."""
        self.total += float(n.sum()) + float((self.alone[places] == 0).sum())
        self.alone[places] += n

    def close(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def _by_context(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts of pairs in order, their sums, and how many pairs each has."""
    prev = names >> WIDE
    heads = np.flatnonzero(np.append(True, prev[1:] != prev[:-1]))
    return prev[heads], np.add.reduceat(n, heads), np.diff(np.append(heads, len(prev)))


def _one(interval: int, n: float, loss: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "interval": pa.array([interval], pa.int32()), "n": pa.array([int(n)], pa.int64()), "loss": pa.array([loss], pa.float64()),
    })


class _Log(_Counts):
    """Scores each interval's own pairs, then counts them."""

    def __init__(self, share: float):
        super().__init__(share)
        self.pairs, self.n = _Index(), np.zeros(0)
        self.contexts, self.in_context = _Index(), np.zeros(0)

    def step(self, interval: int, told: dict[int, list]) -> Iterator[pa.RecordBatch]:
        single, n_single = self.told(told, SINGLE)
        at_single = self.places(single)
        names, n = self.told(told, PAIR)
        if len(names):
            pair = self.pairs.places(names)
            self.n = _grown(self.n, self.pairs.size)
            prev, sums, sizes = _by_context(names, n)
            context = self.contexts.places(prev)
            self.in_context = _grown(self.in_context, self.contexts.size)
            # Every second token of a pair is one of the single tokens of its interval.
            alone = self.alone[at_single][np.searchsorted(single, names & np.uint64(0xFFFFFFFF))]
            p = self.share * self.n[pair] / np.repeat(np.maximum(self.in_context[context], 1), sizes)
            p += (1.0 - self.share) * (alone + 1) / (self.total + 1)
            yield _one(interval, n.sum(), -float(np.dot(np.log(p), n)))
            self.n[pair] += n
            self.in_context[context] += sums
        self.add(at_single, n_single)


class _Held(_Counts):
    """Scores the held-out pairs of its block after each interval, also after empty ones.

    A pair that the run has not shown yet has its token's share alone, so such pairs are summed
    by token; those it has shown are kept in the order they came, in arrays.
    """

    def __init__(self, share: float, n_intervals: int):
        super().__init__(share)
        self.ahead, self.n_intervals, self.keys = 0, n_intervals, None

    def hold(self, told: dict[int, list]) -> None:
        self.keys, weight = self.told(told, HELD)
        lone, lone_weight = self.told(told, LONE)
        self.contexts, self.context_of = np.unique(self.keys >> WIDE, return_inverse=True)
        self.in_context = np.zeros(len(self.contexts))
        following = self.keys & np.uint64(0xFFFFFFFF)
        names, at = np.unique(np.concatenate([following, lone]), return_inverse=True)
        self.asked = self.places(names)
        self.token_of, self.weight = at[: len(following)], weight.astype(float)
        # Weights of pairs not shown yet, by token.
        self.unseen = np.bincount(at, np.concatenate([weight, lone_weight]), len(names)).astype(float)
        self.all = float(self.unseen.sum())
        self.place, self.seen = np.full(len(self.keys), -1, np.int64), 0
        # Of pairs shown, in the order they came: counts, weights, context and token.
        self.n, self.w = np.zeros(len(self.keys)), np.zeros(len(self.keys))
        self.c, self.t = np.zeros(len(self.keys), np.intp), np.zeros(len(self.keys), np.intp)

    def scored(self, until: int) -> Iterator[pa.RecordBatch]:
        for interval in range(self.ahead, until if self.all else 0):
            context = self.share / np.maximum(self.in_context, 1)
            single = (1.0 - self.share) * (self.alone[self.asked] + 1) / (self.total + 1)
            loss = float(np.dot(np.log(single), self.unseen))
            for a in range(0, self.seen, self.chunk):
                some = slice(a, min(a + self.chunk, self.seen))
                p = context.take(self.c[some], mode="clip")
                p *= self.n[some]
                p += single.take(self.t[some], mode="clip")
                loss += float(np.dot(np.log(p, out=p), self.w[some]))
            yield _one(interval, self.all, -loss)
        self.ahead = max(self.ahead, until)

    def step(self, interval: int, told: dict[int, list]) -> Iterator[pa.RecordBatch]:
        if interval < 0 or self.keys is None:
            self.hold(told)
            if interval < 0:
                return
        yield from self.scored(interval)
        self.add(*self._placed(told))
        names, n = self.told(told, PAIR)
        if len(names) and len(self.keys):
            prev, sums, _ = _by_context(names, n)
            at, known = self._found(self.contexts, prev)
            self.in_context[at] += sums[known]
            at, known = self._found(self.keys, names)
            new = at[self.place[at] < 0]
            end = self.seen + len(new)
            self.place[new] = np.arange(self.seen, end)
            self.w[self.seen : end] = self.weight[new]
            self.c[self.seen : end], self.t[self.seen : end] = self.context_of[new], self.token_of[new]
            self.unseen -= np.bincount(self.token_of[new], self.weight[new], len(self.unseen))
            self.seen = end
            self.n[self.place[at]] += n[known]

    def _placed(self, told: dict[int, list]) -> tuple[np.ndarray, np.ndarray]:
        names, n = self.told(told, SINGLE)
        return self.places(names), n

    @staticmethod
    def _found(names: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the asked names that are there, and which those are."""
        at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        known = names[at] == asked
        return at[known], known

    def close(self) -> Iterator[pa.RecordBatch]:
        return self.scored(self.n_intervals) if self.keys is not None else iter(())


def _run(tokens: DataFrame, n_intervals: int, ids: str) -> DataFrame:
    """``interval, ids`` of a run, the rows of an interval next to each other."""
    small_batches(tokens.sparkSession)
    run = tokens.where(F.col("interval").between(0, n_intervals - 1))
    run = run.select(F.col("interval").cast("int").alias("interval"), F.col(ids).cast("array<int>").alias("ids"))
    return run.where(F.size("ids") > 1).repartition("interval").sortWithinPartitions("interval")


def _blocks(tokens: DataFrame) -> int:
    return max(1, STRETCHES, tokens.sparkSession.sparkContext.defaultParallelism)


def counted_run(tokens: DataFrame, n_intervals: int, ids: str = "input_ids", pad_id: int = UNK_ID) -> DataFrame:
    """Messages of token rows with ``interval`` 0 to ``n_intervals - 1``. Settle them when more
    than one figure of the run is asked for: they take about a byte for each pair."""
    return _counted(_run(tokens, n_intervals, ids), _blocks(tokens), pad_id)


def run_pairs(counted: DataFrame) -> DataFrame:
    """``lm.checkpoint_counts`` of ``counted_run``: one row for each pair of an interval."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, n = _read(row)
                following = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                if row["kind"] == LONE:
                    prev = pa.nulls(len(names), pa.int32())
                else:
                    prev = pa.array((names >> WIDE).astype(np.uint32).view(np.int32))
                interval = pa.array(np.full(len(names), row["interval"], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [prev, pa.array(following), interval, pa.array(n)], ["prev", "next", "interval", "n"]
                )

    return counted.where(F.col("kind").isin(PAIR, LONE)).mapInArrow(rows, "prev int, next int, interval int, n long")


def replayed_log(
    tokens: DataFrame, n_intervals: int, share: float = BIGRAM_SHARE, ids: str = "input_ids", pad_id: int = UNK_ID,
) -> DataFrame:
    """``lm.run_log`` of token rows with ``interval`` 0 to ``n_intervals - 1``: the same figures
    without a row for each pair and interval."""
    out = _in_order(counted_run(tokens, n_intervals, ids, pad_id), _blocks(tokens), lambda: _Log(share)).groupBy("interval").agg(
        F.sum("n").alias("tokens"), F.sum("loss").alias("loss")
    )
    return out.select("interval", "tokens", (F.col("loss") / F.col("tokens")).alias("loss"))


def replayed_losses(
    tokens: DataFrame, n_checkpoints: int, eval_tokens: DataFrame, share: float = BIGRAM_SHARE,
    ids: str = "input_ids", pad_id: int = UNK_ID, counted: DataFrame | None = None,
) -> DataFrame:
    """``lm.checkpoint_losses`` of token rows with ``interval``: the same figures, with
    held-out pairs times checkpoints evaluated in place instead of joined. ``counted`` is
    ``counted_run`` of the same rows, when that is there already.

    Held-out pairs lie with the block of their context, once; what moves grows with the
    distinct pairs of each interval.
    """
    blocks, chunk = _blocks(tokens), PAIRS
    held = eval_tokens.select(F.lit(-1).alias("interval"), F.col(ids).cast("array<int>").alias("ids")).where(F.size("ids") > 1)
    if counted is None:
        counted = counted_run(tokens, n_checkpoints, ids, pad_id)
    messages = counted.where(F.col("kind") != LONE).union(_counted(held, blocks, pad_id, held=True))

    def state() -> _Held:
        model = _Held(share, n_checkpoints)
        model.chunk = chunk
        return model

    out = _in_order(messages, blocks, state)
    return out.groupBy((F.col("interval") + 1).alias("checkpoint")).agg(
        (F.sum("loss") / F.sum("n")).alias("eval_loss"), F.sum("n").alias("eval_tokens")
    )
