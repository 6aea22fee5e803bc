"""Language-model scores by Katz backoff over word bigrams.

Counts of words and word pairs come from training rows only. Counts up to five are
discounted by Good-Turing; the mass taken off goes to unseen successors through backoff
weights that make every context sum to exactly one. Words never seen share the mass
that discounting took off the seen words.

Blocks of texts ask the owners of words and pairs for their counts. Owners answer in
the order asked and store their share of the count tables, so no text moves to a count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sftprep.llm.store import (
    MESSAGE, asked, block_count, blocked, by_block, from_planes, keep, messages, planes, remainder,
    slices, with_answers,
)
from sftprep.llm.words import mix, ranks, seeded, words_of

# Counts above GT_LIMIT are reliable and lose only RELIABLE of a count, so that every
# context keeps some mass to back off with.
GT_LIMIT, RELIABLE = 5, 0.01
_BEGIN, _END = seeded(2, 3)
_PAIR = np.uint64(0x9FB21C651E98DF25)
_TOLD = f"{MESSAGE}, counted array<long>"


@dataclass
class Tokens:
    """Words and one end per row, each with the token before it."""

    name: np.ndarray
    before: np.ndarray  # index of the token before, -1 at the start of a row
    row: np.ndarray
    pair: np.ndarray


def tokens_of(texts: pa.ChunkedArray) -> Tokens:
    words = words_of(texts, lower=True)
    rows = len(words.first) - 1
    name = np.empty(len(words.name) + rows, np.uint64)
    name[np.arange(len(words.name)) + words.row] = words.name
    ends = words.first[1:] + np.arange(rows)
    name[ends] = _END
    row = np.repeat(np.arange(rows), words.count() + 1)
    before = np.arange(len(name)) - 1
    before[np.r_[0, ends[:-1] + 1][:rows]] = -1
    context = np.where(before >= 0, name[before], _BEGIN)
    return Tokens(name, before, row, mix(context * _PAIR + name))


def _sorted(block: pa.Table) -> pa.Table:
    """Rows of a block in an order that does not depend on how they arrived."""
    return block.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the first key and the steps between: small numbers pack well."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return steps


def _ask(owners: int, pairs: bool):
    """Questions about the words of a block, or about its pairs (of owners further on)."""

    def run(block: pa.Table) -> pa.Table:
        block = _sorted(block)
        tokens = tokens_of(block.column("text"))
        train = block.column("train").to_numpy().astype(bool)[tokens.row]
        keys, place, _ = ranks(tokens.pair if pairs else tokens.name)
        times = np.bincount(place, weights=train, minlength=len(keys)).astype(np.uint32)
        return messages(
            block.column("block")[0].as_py(),
            [
                (owners * pairs + o, planes(_steps(keys[a:b])) + planes(times[a:b]))
                for o, a, b in slices(keys, owners)
            ],
        )

    return run


def _tell(asks: pa.Table) -> pa.Table:
    """Answers ``2 * count + (1 if this is the key's first asker)``, and the stored share.

    The stored row has block -1: sorted keys as steps, their counts, and in ``counted``
    how many keys have each count up to GT_LIMIT + 1, how many there are, and the sum.
    """
    payloads = asks.column("payload").to_pylist()
    sizes = [len(p) // 12 for p in payloads]
    keys = np.concatenate([np.cumsum(from_planes(p, np.uint64, n)) for p, n in zip(payloads, sizes)])
    times = np.concatenate([from_planes(p, np.uint32, n, 8 * n) for p, n in zip(payloads, sizes)])
    distinct, place, _ = ranks(keys)
    total = np.bincount(place, weights=times, minlength=len(distinct)).astype(np.int64)
    first = np.zeros(len(distinct), np.int64)
    first[place[::-1]] = np.arange(len(keys))[::-1]
    answer = 2 * total[place] + (first[place] == np.arange(len(keys)))
    answers = [planes(np.ascontiguousarray(part)) for part in np.split(answer, np.cumsum(sizes)[:-1])]
    known = total > 0
    stored = planes(_steps(distinct[known])) + planes(total[known])
    counted = [int((total == r).sum()) for r in range(1, GT_LIMIT + 2)]
    owner = asks.column("owner")[0].as_py()
    return pa.table(
        {
            "block": pa.array([*asks.column("block").to_pylist(), -1], pa.int32()),
            "owner": pa.array([owner] * (len(answers) + 1), pa.int32()),
            "payload": pa.array([*answers, stored], pa.binary()),
            "counted": pa.array(
                [None] * len(answers) + [[*counted, int(known.sum()), int(total.sum())]],
                pa.list_(pa.int64()),
            ),
        }
    )


class Discounts:
    """Good-Turing discounted counts, from counts of counts.

    ``counted`` holds the number of types seen once, twice, ... GT_LIMIT + 1 times, of
    all types, and the sum of all counts. Where the counts of counts give no discount
    between 0 and 1 (small corpora), half a count is taken off.
    """

    def __init__(self, counted: list[int]):
        *n, self.types, self.total = counted
        tail = (GT_LIMIT + 1) * n[GT_LIMIT] / n[0] if n[0] else 1.0
        self.kept = [0.0]
        for r in range(1, GT_LIMIT + 1):
            d = -1.0
            if n[r - 1] and tail < 1:
                d = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail)
            self.kept.append(r * d if 0 < d < 1 else r - 0.5)
        small = sum(n[:GT_LIMIT])
        mass = sum(x * k for x, k in zip(n, self.kept[1:]))
        above = self.total - sum(x * r for r, x in enumerate(n[:GT_LIMIT], 1))
        mass += above - RELIABLE * (self.types - small)
        self.unseen = 1.0 - mass / self.total if self.total else 1.0

    def of(self, counts: np.ndarray) -> np.ndarray:
        table = np.array(self.kept)
        return np.where(counts <= GT_LIMIT, table[np.minimum(counts, GT_LIMIT)], counts - RELIABLE)

    def share(self, counts: np.ndarray) -> np.ndarray:
        """The unigram probability of words by their count; unseen words are one class."""
        if not self.total:
            return np.ones(len(counts))
        return np.where(counts > 0, self.of(counts) / self.total, self.unseen)


def _answers(answers: pa.Table, keys: np.ndarray, owners: int, shift: int) -> np.ndarray:
    found = dict(zip(answers.column("owner").to_pylist(), answers.column("payload").to_pylist()))
    out = np.zeros(len(keys), np.int64)
    for owner, a, b in slices(keys, owners):
        out[a:b] = from_planes(found[owner + shift], np.int64, b - a)
    return out


_SCORED = "kind int, row long, doc_id long, key long, n long, known long, x double, y double"
_TYPES = {"kind": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "key": pa.int64(), "n": pa.int64(),
          "known": pa.int64(), "x": pa.float64(), "y": pa.float64()}


def _part(size: int, **columns) -> pa.Table:
    return pa.table({
        name: columns[name] if isinstance(columns.get(name), pa.ChunkedArray)
        else pa.array(columns[name], kind) if name in columns else pa.nulls(size, kind)
        for name, kind in _TYPES.items()
    })


def _score(owners: int, words: Discounts, pairs: Discounts):
    """Rows of three kinds: 1 a text's sums, 2 what a context's seen successors take,
    3 how often a text backs off from a context."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _part(0)
        block = _sorted(block)
        size = block.num_rows
        tokens = tokens_of(block.column("text"))
        keys, place, _ = ranks(tokens.name)
        count = (_answers(answers, keys, owners, 0) >> 1)[place]
        ends = _answers(answers, keys, owners, 0)[np.searchsorted(keys, _END)] >> 1
        context = np.where(tokens.before >= 0, count[tokens.before], ends)
        pair_keys, pair_place, _ = ranks(tokens.pair)
        told = _answers(answers, pair_keys, owners, owners)
        pair = (told >> 1)[pair_place]
        share = words.share(count)
        seen = pair > 0
        logs = np.where(
            seen, np.log10(np.where(seen, pairs.of(pair), 1.0) / np.maximum(context, 1)), np.log10(share)
        )
        base = np.log10((count + 0.5) / (words.total + 0.5 * (words.types + 1)))
        total = lambda w: np.bincount(tokens.row, weights=w, minlength=size)
        number = (block.column("block")[0].as_py() << 32) + np.arange(size)
        texts = _part(
            size, kind=np.ones(size, np.int32), row=number, doc_id=block.column("doc_id"),
            n=total(None).astype(np.int64), known=total(count > 0).astype(np.int64), x=total(base), y=total(logs),
        )
        names = np.where(tokens.before >= 0, tokens.name[tokens.before], _BEGIN)
        # The first asker of a pair reports it, so each distinct pair counts once.
        one = np.zeros(len(pair_keys), np.int64)
        one[pair_place] = np.arange(len(tokens.pair))
        one = one[(told & 1 == 1) & (told > 1)]
        group, at, _ = ranks(names[one])
        there = np.zeros(len(group), np.int64)
        there[at] = context[one]
        taken = _part(
            len(group), kind=np.full(len(group), 2, np.int32), key=group.view(np.int64), n=there,
            x=np.bincount(at, weights=pairs.of(pair[one]), minlength=len(group)),
            y=np.bincount(at, weights=share[one], minlength=len(group)),
        )
        back = np.flatnonzero(~seen & (context > 0))
        group, at, times = ranks(mix(names[back]) + tokens.row[back].astype(np.uint64) * _PAIR)
        some = np.zeros(len(group), np.int64)
        some[at] = back
        backed = _part(
            len(group), kind=np.full(len(group), 3, np.int32), row=number[tokens.row[some]],
            key=names[some].view(np.int64), n=times,
        )
        return pa.concat_tables([texts, taken, backed])

    return run


def katz_scores(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    ``training`` says which rows the model learns from. Tokens are lower-cased words and
    one end per text; null and empty texts are an end alone. ``score`` is the log10
    probability of the text under the model, ``base_score`` under add-half word counts.
    Without training rows every token has probability 1 under the model.

    Count tables (words and pairs, in parts by key) and backoff weights are written to
    the shared folder; they grow with the corpus and none is ever shipped whole.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(training, F.lit(False)).alias("train"),
    )
    owners = block_count(texts)
    rows = blocked(texts, owners)
    # Words and pairs are counted one after the other, so only one is on the disks at a time.
    told = reduce(
        DataFrame.union,
        [keep(asked(by_block(rows, _ask(owners, p), MESSAGE), _tell, _TOLD)) for p in (False, True)],
    )
    is_word = F.col("owner") < owners
    sums = told.where("block = -1").groupBy(is_word.alias("words")).agg(
        F.array(*[F.sum(F.col("counted")[i]) for i in range(GT_LIMIT + 3)]).alias("counted")
    )
    counted = {r["words"]: r["counted"] for r in sums.collect()}  # two rows
    nothing = [0] * (GT_LIMIT + 3)
    words, pairs = (Discounts(counted.get(k, nothing)) for k in (True, False))
    answers = told.where("block >= 0").select("block", "owner", "payload")
    scored = keep(with_answers(rows, answers, _score(owners, words, pairs), _SCORED))
    weights = keep(
        scored.where("kind = 2").groupBy("key").agg(
            F.max("n").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y")
        ).select("key", F.log10((1 - F.col("x") / F.col("n")) / (1 - F.col("y"))).alias("backoff"))
    )
    backed = (
        scored.where("kind = 3").select("row", "key", "n").join(weights, "key")
        .groupBy("row").agg(F.sum(F.col("n") * F.col("backoff")).alias("backed"))
    )
    return scored.where("kind = 1").join(backed, "row", "left").select(
        "doc_id", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), F.col("x").alias("base_score"),
        (F.col("y") + F.coalesce("backed", F.lit(0.0))).alias("score"),
    )


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all rows by a model of those that are not held out."""
    scores = katz_scores(docs, remainder("doc_id", 5) != 1)
    return scores.withColumn("held_out", remainder("doc_id", 5) == 1)
