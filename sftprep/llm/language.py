"""Language identification with hyperdimensional profiles.

Each letter has a random vector of signs. A trigram's vector binds its letters: the
first rotated twice, the second once, multiplied place by place. A text's vector bundles
(adds) the vectors of all its trigrams, a language's prototype those of all its training
texts, and a text takes the language of the prototype with the largest cosine.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sftprep.llm.store import byte_slices, remainder, texts_of
from sftprep.llm.words import seeded_at

DIMENSIONS = 1024
UNKNOWN = "und"
# A trigram's id holds three code points of 21 bits; point 0 is the gap between words.
_BITS = 21
_POINT = (1 << _BITS) - 1
_GAP = 0
_ROWS = 256
# Trigram vectors made at a time, and distinct trigrams a task counts before it tells them.
_VECTORS, _COUNTED = 4096, 1 << 20
# Up to this many letters, trigrams are told apart by a table instead of by sorting.
_TABLE_LETTERS = 128
_KEPT: dict[str, np.ndarray] = {}


def lower_letters() -> np.ndarray:
    """The code point of the lower case of every letter, -1 for anything else."""
    if "letters" not in _KEPT:
        table = np.full(sys.maxunicode + 1, -1, np.int32)
        for point in range(sys.maxunicode + 1):
            letter = chr(point)
            if letter.isalpha():
                table[point] = ord(letter.lower()[0])
        _KEPT["letters"] = table
    return _KEPT["letters"]


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """A vector of signs for each code point, the same in every process."""
    # Lower-case letters begin at ``a``; the gap comes before them.
    rows = np.maximum(points.astype(np.int64) - 96, 0)
    bits = seeded_at(rows[:, None] * dimensions + np.arange(dimensions), 10)
    return np.where(bits & np.uint64(1), 1, -1).astype(np.int8)


def bound(trigrams: np.ndarray, dimensions: int) -> np.ndarray:
    """The vectors of trigram ids, bound from permuted letter vectors."""
    points = np.stack([trigrams >> 2 * _BITS, trigrams >> _BITS & _POINT, trigrams & _POINT])
    letters, place = np.unique(points, return_inverse=True)
    first, second, third = place.reshape(points.shape)
    vectors = letter_vectors(letters, dimensions)
    return np.roll(vectors, 2, axis=1)[first] * np.roll(vectors, 1, axis=1)[second] * vectors[third]


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram ids of all texts and the row each is in; runs of other characters are gaps."""
    lower = lower_letters()
    ids, rows = [], []
    for row, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = lower[points]
        letter = found >= 0
        # One gap for each run of other characters, and one at either end.
        stay = letter.copy()
        stay[1:] |= letter[:-1]
        line = np.concatenate([[_GAP], np.where(letter, found, _GAP)[stay], [_GAP]]).astype(np.int64)
        if letter.any() and len(line) >= 3:
            ids.append(line[:-2] << 2 * _BITS | line[1:-1] << _BITS | line[2:])
            rows.append(np.full(len(line) - 2, row, np.int32))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(ids), np.concatenate(rows)


def compact(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram ids in order, and the place of each id among them."""
    seen = np.zeros(_POINT + 1, bool)
    for shift in (2 * _BITS, _BITS, 0):
        seen[ids >> shift & _POINT] = True
    letters = np.flatnonzero(seen)
    n = len(letters)
    if n > _TABLE_LETTERS:
        used, place = np.unique(ids, return_inverse=True)
        return used, place.reshape(-1)
    number = np.zeros(_POINT + 1, np.int32)
    number[letters] = np.arange(n)
    small = (number[ids >> 2 * _BITS] * n + number[ids >> _BITS & _POINT]) * n + number[ids & _POINT]
    met = np.zeros(n**3, bool)
    met[small] = True
    used = np.flatnonzero(met)
    place = np.zeros(n**3, np.int32)
    place[used] = np.arange(len(used))
    return letters[used // n**2] << 2 * _BITS | letters[used // n % n] << _BITS | letters[used % n], place[small]


def _bundles():
    """Trigram counts per language of the rows a task reads, a bounded number at a time."""

    def told(found):
        for lang, (ids, n) in sorted(found.items(), key=lambda f: str(f[0])):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(n, pa.int64())],
                ["lang", "trigram", "n"],
            )

    def run(batches):
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part in byte_slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                ids, rows = trigrams(part.column("text"))
                for lang in sorted(set(langs.tolist())):
                    used, place = compact(ids[(langs == lang)[rows]])
                    n = np.bincount(place, minlength=len(used)).astype(np.int64)
                    if lang in found:
                        used, place = np.unique(np.concatenate([found[lang][0], used]), return_inverse=True)
                        both = np.concatenate([found[lang][1], n])
                        n = np.zeros(len(used), np.int64)
                        np.add.at(n, place.reshape(-1), both)
                    found[lang] = used, n
                if sum(len(f[0]) for f in found.values()) > _COUNTED:
                    yield from told(found)
                    found = {}
        yield from told(found)

    return run


def _bundled(dimensions: int):
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            ids = batch.column("trigram").to_numpy()
            counts = batch.column("n").to_numpy().astype(np.float64)
            for lang in sorted(set(langs.tolist())):
                own = langs == lang
                total = np.zeros(dimensions)
                for at in range(0, int(own.sum()), _VECTORS):
                    some = np.flatnonzero(own)[at : at + _VECTORS]
                    total += counts[some] @ bound(ids[some], dimensions).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions), pa.int32()),
                        pa.array(total, pa.float64()),
                    ],
                    ["lang", "place", "value"],
                )

    return run


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``lang, vector``: the bundle of each language's ``(text, lang)`` rows.

    Bundling is a sum, so trigrams are counted first, where the rows lie; a language
    that holds a third of all rows arrives as one count per trigram and task.
    """
    counts = (
        labelled.select("text", "lang").mapInArrow(_bundles(), "lang string, trigram long, n long")
        .groupBy("lang", "trigram").agg(F.sum("n").alias("n"))
    )
    return (
        counts.mapInArrow(_bundled(dimensions), "lang string, place int, value double")
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
        .select("lang", F.col("v.value").alias("vector"))
    )


def _text_vectors(ids: np.ndarray, rows: np.ndarray, n: int, dimensions: int) -> np.ndarray:
    """The bundle of each of ``n`` texts, from a bounded number of trigram vectors at a time."""
    used, place = compact(ids)
    order = np.argsort(place, kind="stable") if len(used) > _VECTORS else np.arange(len(place))
    place, rows = place[order], rows[order].astype(np.int64)
    out = np.zeros((n, dimensions), np.float32)
    for at in range(0, len(used), _VECTORS):
        some = used[at : at + _VECTORS]
        a, b = np.searchsorted(place, [at, at + len(some)]) if len(used) > _VECTORS else (0, len(place))
        cell = rows[a:b] * len(some) + (place[a:b] - at)
        counts = np.bincount(cell, minlength=n * len(some)).reshape(n, -1).astype(np.float32)
        out += counts @ bound(some, dimensions).astype(np.float32)
    return out


def _named(langs: list[str], vectors: np.ndarray, dimensions: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", rows=_ROWS):
                n = part.num_rows
                ids, rows = trigrams(part.column("text"))
                names, score = [UNKNOWN] * n, np.zeros(n)
                has = np.bincount(rows, minlength=n) > 0
                if len(ids) and langs:
                    own = _text_vectors(ids, rows, n, dimensions)
                    length = np.maximum(np.linalg.norm(own, axis=1), 1e-9)
                    cosine = (own @ vectors.T) / length[:, None]
                    best = cosine.argmax(axis=1)
                    names = [langs[b] if h else UNKNOWN for b, h in zip(best, has)]
                    score = np.where(has, np.clip(cosine.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(names, pa.string()),
                        pa.array(score.astype(np.float64), pa.float64()), pa.array(has, pa.bool_()),
                    ],
                    ["doc_id", "lang_pred", "score", "lettered"],
                )

    return run


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """``doc_id, lang_pred, score, lettered``: the nearest prototype and its cosine, per row.

    ``labelled`` holds ``text`` and non-null ``lang``. A text that is null or has no
    letter is ``und`` with score 0, as is every text when nothing is labelled;
    ``lettered`` tells the two apart. Ties go to the language that sorts first. One vector per language reaches every task: their
    number times the dimensions, whatever the size of the corpus.
    """
    # As many rows as there are languages.
    known = prototypes(labelled.where("lang is not null and text is not null"), dimensions)
    found = sorted((r["lang"], r["vector"]) for r in known.collect())
    langs = [lang for lang, _ in found]
    vectors = np.array([v for _, v in found], np.float32).reshape(-1, dimensions)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return texts_of(docs, id_col, text_col).mapInArrow(
        _named(langs, vectors, dimensions), "doc_id long, lang_pred string, score double, lettered boolean"
    )


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Predictions for all rows, learned from those whose id is not held out."""
    training = docs.where(remainder("doc_id", 3) != 1).select("text", "lang")
    return identify(docs, training).withColumn("held_out", remainder("doc_id", 3) == 1)
