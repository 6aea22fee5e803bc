"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

Texts are counted by pairs of neighbouring bytes and words that follow themselves, weighted by tf-idf and projected on
the leading singular vectors of a bounded labelled sample. Each document's exact cosine
with every labelled vector is computed in blocks; its nearest neighbours vote with
their similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sftprep.llm.store import byte_slices, remainder, texts_of
from sftprep.llm.words import mix, text_bytes, words_of

# At most this many labelled rows are shipped, the first by a hash of their id: the
# vectors of all tasks stay at LABELLED * LATENT floats however many labels there are.
LABELLED = 4096
FEATURES = 4096
LATENT = 64
NEIGHBOURS = 15
THRESHOLD = 0.3
# Weight of the share of words that follow themselves, beside byte pairs of length 1.
REPEATS = 2.0
_ROWS = 256
_SLOT = (mix(np.arange(65536, dtype=np.uint64) + np.uint64(77)) % np.uint64(FEATURES - 1)).astype(np.int64) + 1


def counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte pairs, one row per text."""
    data, places = text_bytes(texts)
    out = np.zeros((len(places) - 1, FEATURES), np.float32)
    for row, (low, high) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
        if high - low > 1:
            pair = data[low : high - 1].astype(np.int64) << 8 | data[low + 1 : high]
            out[row] = np.bincount(_SLOT[pair], minlength=FEATURES)
    # One more feature: the share of words that follow themselves.
    words = words_of(texts)
    again = (words.name[1:] == words.name[:-1]) & (words.row[1:] == words.row[:-1])
    out[:, 0] = np.bincount(words.row[1:][again], minlength=len(out)) / np.maximum(words.count(), 1)
    return out


def _weighted(raw: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    pairs = np.log1p(raw) * rarity
    pairs[:, 0] = 0.0
    pairs = _unit(pairs)
    pairs[:, 0] = REPEATS * raw[:, 0]
    return _unit(pairs)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _sparse(batches):
    for batch in batches:
        for part in byte_slices(batch, "text", rows=_ROWS):
            raw = counts(part.column("text"))
            rows, slots = np.nonzero(raw)
            offsets = pa.array(np.searchsorted(rows, np.arange(len(raw) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("label"),
                    pa.ListArray.from_arrays(offsets, pa.array(slots, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(raw[rows, slots], pa.float32())),
                ],
                ["doc_id", "label", "slots", "counts"],
            )


class Neighbours:
    """Rarity weights, the projection, and the labelled vectors with their labels."""

    def __init__(self, raw: np.ndarray, labels: np.ndarray, latent: int = LATENT):
        self.rarity = (1.0 + np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0)))).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        weighted = _weighted(raw, self.rarity)
        # Subspace iteration for the leading right singular vectors.
        basis = np.random.default_rng(7).standard_normal((FEATURES, min(latent + 16, FEATURES))).astype(np.float32)
        for _ in range(4):
            basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
        small = weighted @ basis
        _, _, turn = np.linalg.svd(small, full_matrices=False) if len(raw) else (0, 0, np.eye(basis.shape[1]))
        self.project = (basis @ turn[:latent].T).astype(np.float32)
        self.vectors = _unit(weighted @ self.project).astype(np.float32)

    def score(self, texts: pa.Array, neighbours: int) -> np.ndarray:
        raw = counts(texts)
        if not len(self.labels):
            return np.full(len(raw), self.prior)
        cosine = _unit(_weighted(raw, self.rarity) @ self.project) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0) ** 4
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where(total > 1e-12, np.clip(voted, 0.0, 1.0), self.prior).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Neighbours:
    """Learns from ``labels (doc_id, label)``: at most ``labelled`` of the rows with a
    label of 0 or 1, taken in the order of a hash of the id."""
    chosen = (
        labels.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    )
    rows = (
        docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", "text")
        .mapInArrow(_sparse, "doc_id long, label int, slots array<int>, counts array<float>")
    ).toArrow().sort_by("doc_id")
    raw = np.zeros((rows.num_rows, FEATURES), np.float32)
    slots, values = rows.column("slots").combine_chunks(), rows.column("counts").combine_chunks()
    if rows.num_rows:
        each = np.diff(slots.offsets.to_numpy())
        raw[np.repeat(np.arange(len(each)), each), slots.flatten().to_numpy()] = values.flatten().to_numpy()
    return Neighbours(raw, rows.column("label").to_numpy().astype(np.float32))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    neighbours: int = NEIGHBOURS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, score, predicted``, one row per input row.

    ``labels`` has ``doc_id`` and ``label``. Null and empty texts, and all texts when
    nothing is labelled, have nothing to compare and get the sample's share of label 1
    (one half without a sample). Among equally near neighbours numpy's partition decides,
    which is the same in every run.
    """
    texts = texts_of(docs, id_col, text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(fit(texts, labels))

    def run(batches):
        model = shipped.value
        for batch in batches:
            for part in byte_slices(batch, "text", rows=_ROWS):
                score = model.score(part.column("text"), neighbours)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(score, pa.float64()),
                        pa.array((score >= threshold).astype(np.int32), pa.int32()),
                    ],
                    ["doc_id", "score", "predicted"],
                )

    return texts.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows, learned from labels of rows that are not held out."""
    training = labels.where(remainder("doc_id", 5) != 0).select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    return quality_scores(docs, training).withColumn("held_out", remainder("doc_id", 5) == 0)
