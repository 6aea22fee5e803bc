"""MinHash near-duplicates by one-permutation hashing with optimal densification.

Each text's set of word shingles is hashed once; the hash space is cut into bins and
the smallest hash of each bin is the signature. Empty bins borrow from a bin drawn by a
hash of the bin itself, the same for every document (optimal densification). Runs of
bins are bands. Documents that share a band bucket are compared with the bucket's hub
(a star), never pair by pair. Members that hubs leave apart are joined by their rarest
shingles and compared as bitmaps, which misses no pair. Every candidate is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sftprep.llm.store import byte_slices, keep, slices_by, texts_of, with_one
from sftprep.llm.words import Words, distinct, mix, seeded, words_of

SHINGLE_WORDS = 5
PERCENT = 75
BINS = 256
BAND_ROWS = 5
# Another round of stars is worth it when one pair in so many was a link; what is left
# then is found by the prefix join.
WORTH_A_ROUND = 50
# Sets are also drawn as bitmaps of this many 64-bit words: the bits in which two differ
# are at most the shingles in which they differ.
BITMAP_WORDS = 8
_ROWS = 1000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = [f"bits{i}" for i in range(BITMAP_WORDS)]


def shingle_sets(words: Words, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row. Fewer words: the sequence as one."""
    name, first, count = words.name, words.first, words.count()
    windows = np.zeros(max(len(name) - size + 1, 0), np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(size):
            windows += name[j : j + len(windows)] * factor
            factor = factor * _STEP
    windows = mix(windows)
    sets = []
    for i, n in enumerate(count.tolist()):
        if n >= size:
            sets.append(distinct(windows[first[i] : first[i + 1] - size + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for x in name[first[i] : first[i + 1]]:
                    whole = whole * _STEP + x
            sets.append(mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` minima per non-empty set; ``bins`` is a power of two."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    place = row * bins + (flat >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    head = np.ones(len(flat), bool)
    head[1:] = place[1:] != place[:-1]
    found = np.zeros(len(sets) * bins, np.uint64)
    full = np.zeros(len(sets) * bins, bool)
    found[place[head]], full[place[head]] = flat[head], True
    found, full = found.reshape(-1, bins), full.reshape(-1, bins)
    # Densification: an empty bin tries bins drawn from (bin, attempt) until one is full.
    rows, cols = np.nonzero(~full & (sizes > 0)[:, None])
    out, attempt = found.copy(), 0
    while len(rows):
        attempt += 1
        draw = (seeded(bins, 1000 + attempt) % np.uint64(bins)).astype(np.int64)[cols]
        hit = full[rows, draw]
        out[rows[hit], cols[hit]] = found[rows[hit], draw[hit]]
        rows, cols = rows[~hit], cols[~hit]
    return out


def band_keys(signature: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit bucket key per band of each signature."""
    bands = signature.shape[1] // band_rows
    cut = signature[:, : bands * band_rows].reshape(-1, bands, band_rows)
    factors = seeded(band_rows, 7) | np.uint64(1)
    return mix((mix(cut) * factors).sum(axis=2, dtype=np.uint64) + seeded(bands, 8))


def _sketch(bins: int, band_rows: int, size: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", rows=_ROWS):
                sets = shingle_sets(words_of(part.column("text"), lower=True), size)
                keys = band_keys(signatures(sets, bins), band_rows).view(np.int64)
                used = np.array([len(s) > 0 for s in sets], bool)
                offsets = np.r_[0, np.cumsum(used * keys.shape[1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(
                            [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                            pa.binary(),
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(keys[used].ravel())
                        ),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    return run


def _full_sets(size: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", rows=_ROWS):
                sets = shingle_sets(words_of(part.column("text"), lower=True), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc_id", "shingles"],
                )

    return run


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set")):
                a = np.frombuffer(a.as_buffer(), np.uint64)
                b = np.frombuffer(b.as_buffer(), np.uint64)
                a, b = (a, b) if len(a) <= len(b) else (b, a)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                near.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]
            ).filter(pa.array(near, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("a_set"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("b_set"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(_similar(percent), "a long, b long")


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """The parity of the shingles that fall on each bit, one row of words per set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = mix(np.concatenate(sets).view(np.uint64) + _STEP) if len(sets) else np.zeros(0, np.uint64)
    bits = 64 * BITMAP_WORDS
    place = np.repeat(np.arange(len(sets)), sizes) * bits + (flat % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, BITMAP_WORDS)


def _bitmaps():
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "shingles", rows=_ROWS):
                drawn = bitmaps([np.frombuffer(s.as_buffer(), np.int64) for s in part.column("shingles")])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(np.ascontiguousarray(w)) for w in drawn.T)],
                    ["doc_id", *_BITS],
                )

    return run


def _shingles():
    """One row per shingle of each set."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "shingles", rows=_ROWS):
                sets = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column("shingles")]
                sizes = np.array([len(s) for s in sets], np.int64)
                row = pa.array(np.repeat(np.arange(len(sets)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(row), part.column("component_id").take(row),
                        pa.array(sizes).take(row), pa.array(np.concatenate(sets)),
                    ],
                    ["doc_id", "component_id", "size", "shingle"],
                )

    return run


def links_between(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs ``(a, b)`` of similar enough ``members`` in different components.

    ``members`` has unique ``doc_id`` and ``component_id``, ``sets`` their ``shingles``.
    Shingles are put in one order, those within one component first and then from rare
    to common. Ends of a link have their first common shingle so early in both sets that
    the shingles from there on can still make up the intersection a link needs. Only
    such places are joined; what many unlinked sets share comes too late in them. Two sets
    that differ in ``d`` bits of their bitmaps differ in ``d`` shingles or more, so places
    whose sets differ in too many bits make no pair: pairs grow with the sets that are
    about as similar as a link, however many share a shingle.
    """
    shingles = (
        sets.join(members.select("doc_id", "component_id"), "doc_id")
        .select("doc_id", "component_id", "shingles")
        .mapInArrow(_shingles(), "doc_id long, component_id long, size long, shingle long")
    )
    between = keep(
        shingles.groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("component_id").alias("low"), F.max("component_id").alias("high"))
        .where("low <> high").select("shingle", "n")
    )
    ordered = (
        shingles.join(between, "shingle").groupBy("doc_id", "component_id", "size")
        .agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("between"))
        .select("doc_id", "component_id", "size", F.size("between").alias("n"), F.posexplode("between").alias("at", "one"))
        # Shingles of the set from this one on.
        .select("doc_id", "component_id", "size", F.col("one.shingle").alias("shingle"), (F.col("n") - F.col("at")).alias("left"))
    )
    drawn = sets.join(members.select("doc_id"), "doc_id", "left_semi").select("doc_id", "shingles").mapInArrow(
        _bitmaps(), ", ".join(["doc_id long", *(f"{w} long" for w in _BITS)])
    )
    early = keep(ordered.where(100 * F.col("left") >= percent * F.col("size")).join(drawn, "doc_id"))
    # The smaller end of a link needs an intersection in proportion to twice its own size.
    x = early.where((100 + percent) * F.col("left") >= 2 * percent * F.col("size")).alias("x")
    y = early.alias("y")
    smaller = (F.col("x.size") < F.col("y.size")) | (
        (F.col("x.size") == F.col("y.size")) & (F.col("x.doc_id") < F.col("y.doc_id"))
    )
    differ = sum((F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in _BITS), F.lit(0))
    # Of shingles in all, a link leaves at most the share (100 - percent) / (100 + percent) in one set only.
    alike = (100 + percent) * differ <= (100 - percent) * (F.col("x.size") + F.col("y.size"))
    enough = (100 + percent) * F.least("x.left", "y.left") >= percent * (F.col("x.size") + F.col("y.size"))
    pairs = (
        x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component_id") != F.col("y.component_id"))
            & smaller & (100 * F.col("x.size") >= percent * F.col("y.size")) & enough & alike,
        )
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
        .distinct()
    )
    return _confirmed(pairs, sets, percent)


def components(links: DataFrame) -> DataFrame:
    """``(doc_id, component_id)``, the smallest id reachable over ``links (a, b)``.

    Each round takes the smallest label next door and then follows labels of labels, so
    stars settle in two rounds and chains in a logarithm of their length.
    """
    both = keep(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    )
    labels = keep(both.groupBy(F.col("a").alias("v")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")
    ))
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "v").select(
            "v", F.least("label", "near").alias("next"), F.col("label").alias("was")
        )
        jump = labels.select(F.col("v").alias("next"), F.col("label").alias("far"))
        moved = keep(
            step.join(jump, "next", "left").select(
                "v", F.least("next", F.coalesce("far", "next")).alias("label"), "was"
            )
        )
        changed = moved.where("label <> was").limit(1).count()
        labels = moved.select("v", "label")
        if not changed:
            return labels.select(F.col("v").alias("doc_id"), F.col("label").alias("component_id"))


def _joined(found: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Components over new links; earlier ones are summed up by the labels they led to."""
    if labels is not None:
        found = found.union(labels.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
    return components(found)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bins: int = BINS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents are linked when ``100 * intersection >= percent * union`` of their sets of
    lower-cased word shingles. Texts without words are linked with nothing. Rows with
    equal sets are one class whatever their number. A null id is never linked and stays.
    Rows that repeat an id share its class.

    A pair at exactly 0.75 shares none of the 51 default buckets with probability 1e-6.
    In each bucket whose members are in different components, the member that meets most
    others is the hub. Each member is compared with one hub a round, the one it shares
    most buckets with outside its component, so a round has at most one pair per member.
    Rounds go on, with new hubs, while they find links for one pair in ``WORTH_A_ROUND``.
    Members that share a bucket and are still in different components are then compared
    by ``links_between``, so every link between sharers of a bucket counts.
    """
    texts = texts_of(docs, id_col, text_col)
    sketches = keep(
        texts.mapInArrow(
            _sketch(bins, band_rows, size),
            "doc_id long, n_shingles long, set_key binary, bands array<long>",
        )
    )
    known = keep(sketches.where("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "set_key"))
    classes = keep(known.groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    entries = (
        sketches.where("doc_id is not null and n_shingles > 0")
        .join(classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"], "left_semi")
        .select("doc_id", F.explode("bands").alias("band"))
    )
    crowds = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowded = keep(entries.join(crowds, "band"))
    score = crowded.groupBy("doc_id").agg(F.sum("n").alias("score"))
    crowded = keep(crowded.select("band", "doc_id").join(score, "doc_id"))
    # Of rows that repeat an id with different texts, the set whose bytes come first counts.
    sets = keep(
        texts.join(crowded.select("doc_id").distinct(), "doc_id", "left_semi")
        .mapInArrow(_full_sets(size), "doc_id long, shingles binary")
        .groupBy("doc_id").agg(F.min("shingles").alias("shingles"))
    )
    members = crowded.withColumn("component_id", F.col("doc_id"))
    labels = None
    while True:
        hubs = keep(
            members.groupBy("band")
            .agg(F.max(F.struct("score", (-F.col("doc_id")).alias("first"), "component_id")).alias("best"))
            .select("band", (-F.col("best.first")).alias("hub"), F.col("best.component_id").alias("hub_component"))
        )
        met = (
            with_one(members, hubs, "band").where("component_id <> hub_component")
            .groupBy("doc_id", "hub").agg(F.count("*").alias("shared"))
        )
        nearest = met.groupBy("doc_id").agg(F.max(F.struct("shared", (-F.col("hub")).alias("first"))).alias("best"))
        pairs = nearest.select("doc_id", (-F.col("best.first")).alias("hub")).select(
            F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")
        ).distinct()
        pairs = keep(pairs)
        found = keep(_confirmed(pairs, sets, percent))
        links = found.count()
        if links or labels is None:
            labels = _joined(found, labels)
        if links * WORTH_A_ROUND <= pairs.count():
            break
        # Buckets whose members are all in one component are done with; a hub serves once.
        members = _apart(
            with_one(members, hubs.select("band", "hub"), "band").where("doc_id <> hub").select("band", "doc_id", "score"),
            labels,
        )
    waiting = keep(_apart(crowded, labels).select("doc_id", "component_id").distinct())
    if not waiting.isEmpty():
        found = keep(links_between(waiting, sets, percent))
        if not found.isEmpty():
            labels = _joined(found, labels)
    reps = classes.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component_id", "rep").alias("component_id")
    )
    named = with_one(known, reps, "set_key").select("doc_id", "n_shingles", "component_id")
    alone = sketches.where("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return named.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with their components, of buckets that hold more than one component."""
    named = keep(
        entries.join(labels, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    )
    mixed = named.groupBy("band").agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
    mixed = mixed.where("low <> high").select("band", F.lit(True).alias("_mixed"))
    return keep(with_one(named, mixed, "band").drop("_mixed"))
