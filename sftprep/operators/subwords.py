"""Subword ids by the merges of a public byte-pair vocabulary file.

Text is cut into words, a worker splits the distinct words of its rows by merging their
bytes and keeps those it meets first, or rows are joined with all words, split once each.
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import cached_property

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from sftprep.functions.columns import PIECE_PATTERN
from sftprep.operators.tokens import ids_by_join, in_parts
from sftprep.session import MAX_SHIPPED_BYTES, settle

# Fixed value: how the byte-pair vocabularies in use are meant to be cut. White space is
# that of Unicode, and a space before a word belongs to it.
WORD_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The tokens of a broadcast stay in memory, so their place names them.
_RANKS: dict[int, dict[bytes, int]] = {}
# Words that a Python worker keeps the ids of, by vocabulary: the first it meets, which frequent
# words are among.
_SPELLED: dict[int, dict[str, list[int]]] = {}
KEPT_WORDS, KEPT_LENGTH = 1 << 17, 64


class Subwords:
    """A vocabulary file of lines ``base64(token) id``: ids are also the order of merges.

    The driver reads the file and every task gets its tokens; a file beyond the limit for
    shipped tables is refused, as is one that lacks a byte or skips an id.
    """

    def __init__(self, spark: SparkSession, path: str):
        if os.path.getsize(path) > MAX_SHIPPED_BYTES:
            raise ValueError(f"{path} is too large to ship")
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(i) for token, i in pairs}
        if sorted(ranks.values()) != list(range(len(pairs))):
            raise ValueError(f"{path} does not number its tokens from 0 without gaps")
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError(f"{path} does not hold every byte")
        self.spark = spark
        self.tokens = sorted(ranks, key=ranks.get)

    @cached_property
    def shipped(self) -> Broadcast:
        return self.spark.sparkContext.broadcast(self.tokens)


def _ranks(shipped: Broadcast) -> dict[bytes, int]:
    """The ids of tokens, built once per Python worker and vocabulary."""
    tokens = shipped.value
    if id(tokens) not in _RANKS:
        _RANKS.clear()
        _RANKS[id(tokens)] = {token: i for i, token in enumerate(tokens)}
    return _RANKS[id(tokens)]


def _spelled(shipped: Broadcast) -> dict[str, list[int]]:
    """The words a Python worker keeps for a vocabulary."""
    tokens = shipped.value
    if id(tokens) not in _SPELLED:
        _SPELLED.clear()
        _SPELLED[id(tokens)] = {}
    return _SPELLED[id(tokens)]


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: of all neighbours that make a token, those of the lowest id merge
    first, the leftmost of equals. Time grows with length times its logarithm."""
    n = len(word)
    end = list(range(1, n + 1))  # where the part that begins here ends; 0: no part begins here
    before = list(range(-1, n - 1))
    waiting: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if 0 <= at and end[at] < n:
            to = end[end[at]]
            rank = ranks.get(word[at:to])
            if rank is not None:
                heapq.heappush(waiting, (rank, at, to))

    for at in range(n - 1):
        offer(at)
    while waiting:
        _, at, to = heapq.heappop(waiting)
        middle = end[at]
        if not middle or middle >= n or end[middle] != to:
            continue  # one of the two has merged with another since
        end[at], end[middle] = to, 0
        if to < n:
            before[to] = at
        offer(before[at])
        offer(at)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def spelled(words: DataFrame, subwords: Subwords) -> DataFrame:
    """``piece, ids`` of distinct ``words (piece)``."""
    shipped = subwords.shipped

    def run(batches):
        ranks = _ranks(shipped)
        for batch in batches:
            lists = [merged(w.encode(), ranks) for w in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(lists, pa.list_(pa.int32()))], ["piece", "ids"])

    return words.mapInArrow(run, "piece string, ids array<int>")


def _spelled_here(shipped: Broadcast):
    @arrow_udf("array<int>")
    def ids(lists: pa.Array) -> pa.Array:
        import pyarrow as pa

        return in_parts(lists, part, pa.list_(pa.int32()))

    def part(lists: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        ranks, kept = _ranks(shipped), _spelled(shipped)
        words = lists.flatten().dictionary_encode()
        found = []
        for word in words.dictionary.to_pylist():
            if (known := kept.get(word)) is None:
                known = merged(word.encode(), ranks)
                if len(kept) < KEPT_WORDS and len(word) <= KEPT_LENGTH:
                    kept[word] = known
            found.append(known)
        parts = pa.array(found, pa.list_(pa.int32())).take(words.indices)
        before = np.r_[0, np.cumsum(pc.list_value_length(parts).to_numpy())]
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return pa.ListArray.from_arrays(pa.array(before[starts], pa.int32()), parts.flatten())

    return ids


def encode(
    df: DataFrame,
    subwords: Subwords,
    text: str = "text",
    out: str = "input_ids",
    pattern: str = WORD_PATTERN,
    via: str = "auto",
) -> DataFrame:
    """Adds ``out``, the ids of each text; a null or empty text has none.

    ``pattern`` cuts a text into words and must cover all of it. Each worker splits the
    distinct words of a part of its rows and keeps a bounded number of them, so its memory
    does not grow with the words of a corpus and no row moves. With ``via="join"`` each
    distinct word is split once and rows are joined with their words. Rows may repeat.
    """
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    rows = df.withColumn("_pieces", words)
    if via == "join":
        return ids_by_join(
            rows, lambda used: settle(spelled(used.distinct(), subwords)), "_pieces", out
        ).drop("_pieces")
    return rows.withColumn(out, _spelled_here(subwords.shipped)("_pieces")).drop("_pieces")


def decode(df: DataFrame, subwords: Subwords, ids: str = "input_ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text that ids spell; bytes that spell no character read U+FFFD.

    Ids outside the vocabulary are left out.
    """
    shipped = subwords.shipped

    @arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        import pyarrow as pa

        return in_parts(lists, part, pa.string())

    def part(lists: pa.Array) -> pa.Array:
        import pyarrow as pa

        tokens = shipped.value
        texts = [
            None if row is None
            else b"".join(tokens[i] for i in row if i is not None and 0 <= i < len(tokens)).decode("utf-8", "replace")
            for row in lists.to_pylist()
        ]
        return pa.array(texts, pa.string())

    return df.withColumn(out, text(ids))


__all__ = ["PIECE_PATTERN", "WORD_PATTERN", "Subwords", "decode", "encode", "merged", "spelled"]
