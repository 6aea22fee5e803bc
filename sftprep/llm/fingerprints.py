"""Document fingerprints from prefix polynomial hashes.

The prefix hashes of a text give the hash of any span in constant time: two spans are
equal when their hashes are, and the longest common extension of two places is found by
binary search. A fingerprint samples the span hashes of all windows of a text, the
smallest of each of 64 classes, so texts that share windows share parts of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sftprep.llm.store import block_count, keep, texts_of
from sftprep.llm.words import mix

WINDOW = 32
PARTS = 64
_EMPTY = "----"
_P = (1 << 31) - 1
_BASES = (1_103_515_245, 1_664_525_021)
_KEPT: dict[str, list[np.ndarray]] = {}
# Ranges of ids sorted side by side; a range is streamed, so its size is no matter.
MOST_RANGES = 8000


def _fold(x: np.ndarray) -> np.ndarray:
    """Values below 2^62 modulo the Mersenne prime 2^31 - 1."""
    x = (x & np.uint64(_P)) + (x >> np.uint64(31))
    x = (x & np.uint64(_P)) + (x >> np.uint64(31))
    return np.where(x >= _P, x - np.uint64(_P), x)


def _tables(n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Powers of both bases and of their inverses, kept per process and doubled as needed."""
    if not _KEPT or len(_KEPT["up"][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, bases in (("up", _BASES), ("down", tuple(pow(b, -1, _P) for b in _BASES))):
            _KEPT[name] = []
            for base in bases:
                table = np.ones(1, np.uint64)
                while len(table) < size:
                    step = np.uint64(pow(base, len(table), _P))
                    table = np.concatenate([table, _fold(table * step)])
                _KEPT[name].append(table)
    return _KEPT["up"], _KEPT["down"]


class PrefixHashes:
    """Modular prefix hashes of one text, by code points."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = len(points)
        up, self.down = _tables(self.size + 1)
        values = points.astype(np.uint64) + np.uint64(1)
        self.prefix = []
        for powers in up:
            prefix = np.zeros(self.size + 1, np.uint64)
            np.cumsum(_fold(values * powers[: self.size]), out=prefix[1:])
            self.prefix.append(_fold(prefix))

    def spans(self, starts: np.ndarray, width: int) -> np.ndarray:
        """The 62-bit hashes of the spans of one width at many places."""
        out = np.zeros(len(starts), np.uint64)
        for prefix, down in zip(self.prefix, self.down):
            difference = prefix[starts + width] + np.uint64(_P) - prefix[starts]
            out = (out << np.uint64(31)) | _fold(_fold(difference) * down[starts])
        return out

    def span(self, start: int, end: int) -> tuple[int, ...]:
        return tuple(
            (int(p[end]) - int(p[start])) * int(d[start]) % _P
            for p, d in zip(self.prefix, self.down)
        )

    def same(self, start: int, other: PrefixHashes, other_start: int, width: int) -> bool:
        """Whether two spans are equal."""
        return self.span(start, start + width) == other.span(other_start, other_start + width)

    def extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """How far the texts agree from two places on, by binary search."""
        low, high = 0, min(self.size - start, other.size - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def sketch(hashes: PrefixHashes, window: int = WINDOW) -> np.ndarray:
    """The smallest window hash of each class as 16 bits, -1 for a class without one."""
    out = np.full(PARTS, -1, np.int64)
    if hashes.size:
        width = min(window, hashes.size)
        keys = np.sort(mix(hashes.spans(np.arange(hashes.size - width + 1), width)))
        part = (keys >> np.uint64(58)).astype(np.int64)
        head = np.ones(len(part), bool)
        head[1:] = part[1:] != part[:-1]
        out[part[head]] = (keys[head] >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)
    return out


def written(parts: np.ndarray) -> str:
    return "".join(_EMPTY if p < 0 else f"{p:04x}" for p in parts.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the parts either has in which both agree; 1 for two empty texts."""
    either = (a >= 0) | (b >= 0)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)
_NAMES = [f.split()[0] for f in _RESULT.split(", ")]


def _row(doc_id, text: str, own: PrefixHashes, own_parts, next_text: str, next_parts) -> tuple:
    changed = edited(text, next_text)
    other = PrefixHashes(changed)
    other_parts = sketch(other)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        written(own_parts), written(other_parts), likeness(own_parts, other_parts),
        likeness(own_parts, next_parts), own.extension(0, other, 0),
    )


def _paired(batches):
    """Pairs each row of a sorted range with the next; the ends are passed on with their text."""
    empty, before, head, rows = (None,) * len(_NAMES), None, None, []

    def flush():
        columns = list(zip(*rows)) if rows else [[]] * (len(_NAMES) + 3)
        fields = pa.schema(
            [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
             ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
             ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64()),
             ("edge", pa.string()), ("edge_id", pa.int64()), ("edge_text", pa.string())]
        )
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)
        rows.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            text = text or ""
            own = PrefixHashes(text)
            parts = sketch(own)
            if before is None:
                head = (doc_id, text)
            else:
                rows.append(_row(*before, text, parts) + (None, None, None))
            before = (doc_id, text, own, parts)
            if len(rows) >= 500:
                yield flush()
    if before is not None:
        rows.append(empty + ("head", *head))
        rows.append(empty + ("tail", before[0], before[1]))
    yield flush()


def _closed(batches):
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("edge_id", "edge_text", "next_text"))):
            own = PrefixHashes(text)
            rows.append(_row(doc_id, text, own, sketch(own), following, sketch(PrefixHashes(following))))
        columns = list(zip(*rows)) if rows else [[]] * len(_NAMES)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _NAMES)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its fingerprint, that of its edited text, and likenesses.

    Rows are taken in descending id, equal ids by text, null ids last; after the last
    comes the first, so a single row follows itself. Null text reads as empty. An empty
    text has a fingerprint of empty parts, like only to another empty text.
    ``common_prefix`` is the longest common prefix of the text and its edited text.

    Texts move once, into sorted ranges of ids; each range is streamed row by row. Only
    the first and the last text of each range meet those of the ranges beside it.
    """
    texts = texts_of(docs, id_col, text_col)
    order = [F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    ranges = min(block_count(texts), MOST_RANGES)
    done = keep(
        texts.repartitionByRange(ranges, F.desc_nulls_last("doc_id"))
        .sortWithinPartitions(*order)
        .mapInArrow(_paired, f"{_RESULT}, edge string, edge_id long, edge_text string")
    )
    # Two rows per range: the last text of each is followed by the head of the next range.
    turn = Window.orderBy(F.desc_nulls_last("edge_id"), F.asc_nulls_first("edge_text"), F.asc("edge"))
    wrap = Window.orderBy(F.asc("edge"), F.desc_nulls_last("edge_id"), F.asc_nulls_first("edge_text"))
    edges = done.where("edge is not null").select("edge", "edge_id", "edge_text")
    followed = (
        edges.withColumn("first_text", F.first("edge_text").over(wrap))
        .withColumn("next_text", F.lead("edge_text").over(turn))
        .where("edge = 'tail'")
        .select("edge_id", "edge_text", F.coalesce("next_text", "first_text").alias("next_text"))
    )
    return done.where("edge is null").select(*_NAMES).union(followed.mapInArrow(_closed, _RESULT))
