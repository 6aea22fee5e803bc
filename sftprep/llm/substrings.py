"""Substring deduplication by recompression.

Every document is parsed in rounds: runs of one symbol get a name, then pairs of a left
symbol and a right symbol get a name, where a hash of the symbol itself says on which
side it is. Names are hashes of what they stand for, so all documents use the same names
without asking anyone, and equal word sequences get equal symbols in their interior.
A symbol that occurs once in the corpus shows that nothing around it repeats. Only
windows without such a symbol are named and compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sftprep.llm.store import (
    MESSAGE, asked, block_count, blocked, by_block, keep, messages, slices, texts_of, with_answers,
)
from sftprep.llm.words import Words, mix, ranks, span_hashes, words_of

WINDOW = 20
ROUNDS = 3
_RUN, _LEFT, _RIGHT = (np.uint64(x) for x in (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9))
_LAST = np.iinfo(np.int64).max


@dataclass
class Symbols:
    """Symbols of one level; ``low`` and ``high`` bound the words their name depends on.

    Whatever holds the words from ``low`` to ``high`` holds the same symbol. Where a name
    depends on the end of a document, the bound lies outside the document.
    """

    name: np.ndarray
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _beside(symbols: Symbols, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per symbol, the bounds with its left and its right neighbour taken in."""
    row, outside = symbols.row, first[symbols.row] - 1
    left = np.r_[outside[:1], np.where(row[1:] == row[:-1], symbols.low[:-1], outside[1:])]
    outside = first[row + 1] + 1
    right = np.r_[np.where(row[1:] == row[:-1], symbols.high[1:], outside[:-1]), outside[-1:]]
    return left, right


def name_runs(symbols: Symbols, first: np.ndarray) -> Symbols:
    """Each run of one symbol becomes a symbol named by the symbol and its number."""
    name, row = symbols.name, symbols.row
    head = np.ones(len(name), bool)
    head[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(head)
    tails = np.r_[heads[1:], len(name)] - 1
    left, right = _beside(symbols, first)
    times = (tails - heads + 1).astype(np.uint64)
    named = np.where(times > 1, mix(name[heads] * _RUN + times), name[heads])
    return Symbols(named, row[heads], left[heads], right[tails])


def name_pairs(symbols: Symbols, first: np.ndarray, round_no: int) -> Symbols:
    """Each left symbol before a right symbol becomes one symbol named by both."""
    name, row = symbols.name, symbols.row
    is_left = (mix(name + np.uint64(round_no + 1)) & np.uint64(1)).astype(bool)
    joined = np.zeros(len(name), bool)
    joined[:-1] = is_left[:-1] & ~is_left[1:] & (row[1:] == row[:-1])
    second = np.r_[False, joined[:-1]]
    left, right = _beside(symbols, first)
    following = np.r_[np.arange(1, len(name)), len(name) - 1]
    named = np.where(joined, mix(name * _LEFT + name[following] * _RIGHT), name)
    # A pair stands for itself; a symbol left alone depends on the side it looks to.
    low = np.where(joined | is_left, symbols.low, left)
    high = np.where(joined, symbols.high[following], np.where(is_left, right, symbols.high))
    stays = ~second
    return Symbols(named[stays], row[stays], low[stays], high[stays])


def parsed(words: Words, rounds: int = ROUNDS) -> Symbols:
    at = np.arange(len(words.name))
    symbols = Symbols(words.name, words.row, at, at + 1)
    if len(at):
        for round_no in range(rounds):
            symbols = name_runs(symbols, words.first)
            symbols = name_pairs(symbols, words.first, round_no)
    return symbols


def _opened(block: pa.Table) -> tuple[pa.Table, Words]:
    """The rows of a block in the order that says which is earlier, and their words."""
    block = block.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return block, words_of(block.column("text"))


def _block_no(block: pa.Table) -> int:
    return block.column("block")[0].as_py()


def _ask_symbols(owners: int, rounds: int):
    def run(block: pa.Table) -> pa.Table:
        _, words = _opened(block)
        keys, _, times = ranks(parsed(words, rounds).name)
        more = (times > 1).astype(np.uint8)
        return messages(
            _block_no(block),
            [(o, keys[a:b].tobytes() + more[a:b].tobytes()) for o, a, b in slices(keys, owners)],
        )

    return run


def _tell_repeats(asks: pa.Table) -> pa.Table:
    payloads = asks.column("payload").to_pylist()
    sizes = [len(p) // 9 for p in payloads]
    keys = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(payloads, sizes)])
    more = np.concatenate([np.frombuffer(p, np.uint8, n, 8 * n) for p, n in zip(payloads, sizes)])
    _, place, _ = ranks(keys)
    repeats = np.bincount(place, weights=1 + more)[place] > 1
    return _answered(asks, repeats, sizes)


def _answered(asks: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": asks.column("block").cast(pa.int32()),
            "owner": asks.column("owner").cast(pa.int32()),
            "payload": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
        }
    )


def _flags(answers: pa.Table, keys: np.ndarray, owners: int) -> np.ndarray:
    """One answer bit per key of a sorted array."""
    found = dict(zip(answers.column("owner").to_pylist(), answers.column("payload").to_pylist()))
    out = np.zeros(len(keys), bool)
    for owner, a, b in slices(keys, owners):
        out[a:b] = np.unpackbits(np.frombuffer(found[owner], np.uint8), count=b - a)
    return out


def _candidates(words: Words, answers: pa.Table, owners: int, window: int, rounds: int):
    """Starts of windows all of whose symbols repeat, and two hashes of each."""
    symbols = parsed(words, rounds)
    keys, place, _ = ranks(symbols.name)
    single = ~_flags(answers, keys, owners)[place] if len(keys) else np.zeros(0, bool)
    low, high = symbols.low[single], symbols.high[single]
    narrow = high - low <= window
    low, high = low[narrow], high[narrow]
    size = len(words.name)
    turns = np.zeros(size + 2, np.int64)
    np.add.at(turns, np.clip(high - window, 0, size), 1)
    np.add.at(turns, np.clip(low + 1, 0, size), -1)
    fits = np.arange(size) + window <= words.first[words.row + 1]
    starts = np.flatnonzero(fits & (np.cumsum(turns)[:size] <= 0))
    one = span_hashes(words.name, starts, starts + window)
    two = span_hashes(mix(words.name + np.uint64(9)), starts, starts + window)
    return starts, one, (two & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _distinct_windows(one: np.ndarray, two: np.ndarray):
    """Distinct windows in order of their hash, each occurrence's window, and the first
    occurrence of each."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    return a[heads], b[heads], place, order[heads]


def _ids(block: pa.Table) -> np.ndarray:
    return block.column("doc_id").fill_null(_LAST).to_numpy()


def _ask_windows(owners: int, window: int, rounds: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return messages(0, [])
        ordered, words = _opened(block)
        starts, one, two = _candidates(words, answers, owners, window, rounds)
        keys, check, _, first = _distinct_windows(one, two)
        ids = _ids(ordered)[words.row[starts[first]]].astype(np.int64)
        return messages(
            _block_no(block),
            [
                (o, keys[a:b].tobytes() + ids[a:b].tobytes() + check[a:b].tobytes())
                for o, a, b in slices(keys, owners)
            ],
        )

    return run


def _tell_earlier(asks: pa.Table) -> pa.Table:
    payloads = asks.column("payload").to_pylist()
    sizes = [len(p) // 20 for p in payloads]
    read = lambda kind, at: np.concatenate(
        [np.frombuffer(p, kind, n, at * n) for p, n in zip(payloads, sizes)]
    )
    keys, ids, check = read(np.uint64, 0), read(np.int64, 8), read(np.uint32, 16)
    kept, _, place, _ = _distinct_windows(keys, check)
    earliest = np.full(len(kept), _LAST, np.int64)
    np.minimum.at(earliest, place, ids)
    return _answered(asks, earliest[place] < ids, sizes)


def _cut(owners: int, window: int, rounds: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({n: pa.array([], t) for n, t in _CUT.items()})
        ordered, words = _opened(block)
        kind = answers.column("step").to_numpy()
        symbols, windows = answers.filter(pa.array(kind == 1)), answers.filter(pa.array(kind == 2))
        starts, one, two = _candidates(words, symbols, owners, window, rounds)
        keys, _, place, first = _distinct_windows(one, two)
        elsewhere = _flags(windows, keys, owners)
        again = elsewhere[place] if len(place) else np.zeros(0, bool)
        again[np.setdiff1d(np.arange(len(place)), first, assume_unique=True)] = True
        turns = np.zeros(len(words.name) + 1, np.int64)
        np.add.at(turns, starts[again], 1)
        np.add.at(turns, starts[again] + window, -1)
        gone = np.cumsum(turns)[: len(words.name)] > 0
        removed = np.bincount(words.row, weights=gone, minlength=ordered.num_rows).astype(np.int64)
        texts = []
        for row, text in enumerate(ordered.column("text").to_pylist()):
            own = (text or "").encode().split()
            if removed[row]:
                own = compress(own, ~gone[words.first[row] : words.first[row + 1]])
            texts.append(b" ".join(own).decode())
        return pa.table(
            {
                "doc_id": ordered.column("doc_id"),
                "n_words": pa.array(words.count(), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(texts, pa.string()),
            }
        )

    return run


_CUT = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string()}


def repeats_removed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``, one row per input row.

    A word goes when a window of ``window`` words that covers it also starts earlier: in
    a smaller id, or in the same document before. Windows are judged on the input. Kept
    words are joined by one space; null text has no words. Rows that repeat an id follow
    each other in the order of their texts; rows without an id come last, as one document.

    Windows are compared by 96-bit hashes of their words. Blocks of texts ask about each
    symbol and each window once, so a passage that a third of all documents hold costs
    one question per block.
    """
    texts = texts_of(docs, id_col, text_col)
    blocks = block_count(texts)
    rows = blocked(texts, blocks)
    symbols = keep(asked(by_block(rows, _ask_symbols(blocks, rounds), MESSAGE), _tell_repeats))
    windows = keep(
        asked(with_answers(rows, symbols, _ask_windows(blocks, window, rounds), MESSAGE), _tell_earlier)
    )
    answers = symbols.withColumn("step", F.lit(1)).union(windows.withColumn("step", F.lit(2)))
    return with_answers(
        rows, answers, _cut(blocks, window, rounds),
        "doc_id long, n_words long, n_removed long, kept_text string",
    )
