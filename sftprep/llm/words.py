"""Words of a whole Arrow batch at once, as numpy arrays.

A word is a run of bytes other than space and the control characters 9 to 13. All
texts of a batch lie in one buffer, so every step is one pass over that buffer and no
Python statement runs per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit keys over all 64 bits (a bijection, so distinct stay distinct)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values for a seed."""
    return seeded_at(np.arange(n, dtype=np.uint64), seed)


def seeded_at(places: np.ndarray, seed: int) -> np.ndarray:
    """The values at ``places`` of the endless sequence that ``seeded`` begins."""
    start = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
    return mix(start + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_WORDS_AT_ONCE = 1 << 13
_BASE = 0xD6E8FEB86659FD93
_TABLES: dict[str, np.ndarray] = {"bytes": seeded(256, 1)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, kept per process."""
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["up"], _TABLES["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans ``values[start:end]``, equal wherever equal spans lie."""
    up, down = _powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    own = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Words:
    """Words of a batch: byte spans, the row each is in, and a 64-bit name."""

    data: np.ndarray  # all bytes of the batch
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # row of each word, not decreasing
    first: np.ndarray  # index of the first word of each row, and one more at the end
    name: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    data, places = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    full = places[:-1] < places[1:]
    heads, tails = places[:-1][full], places[1:][full] - 1
    begins[heads] = inside[1:-1][heads]
    stops[tails] = inside[1:-1][tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, places)
    row = np.repeat(np.arange(len(places) - 1), np.diff(first))
    # A few words at a time, so that the eight bytes per character stay in the cache.
    name = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), _WORDS_AT_ONCE):
        j = min(i + _WORDS_AT_ONCE, len(starts))
        low = starts[i]
        values = _TABLES["bytes"][data[low : ends[j - 1]]]
        name[i:j] = span_hashes(values, starts[i:j] - low, ends[i:j] - low)
    return Words(data, starts, ends, row, first, name)


def ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of each key among them, and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    return keys[heads], place, np.diff(np.append(heads, len(keys)))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys in order."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]
