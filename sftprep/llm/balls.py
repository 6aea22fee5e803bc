"""Ranked lexical search by an exact ball tree over sparse vectors.

A document's vector has an integer impact for each term that any query holds; a query's
has the weight of each of its terms, so a score is an inner product of integers. Each
task builds a tree over the documents it reads, some thousand at a time: documents are
split at the median between two far pivots until a few are left, and every ball keeps its
centroid and how far its documents lie from it, over all terms and along each one. By
these no document of a ball can score above ``<q, centroid> + |q| * radius``, nor above
the same sum taken term by term. Balls are opened best first; those whose bound lies below
the k-th best score so far are left out with all they hold. Leaves are scored exactly in
64-bit integers. Bounds are rounded up, so rounding never costs a document its place.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sftprep.llm.store import byte_slices, keep, texts_of
from sftprep.llm.words import Words, mix, ranks, text_bytes, words_of

TOP = 20
LEAF_DOCS = 16
# A tree is built over this many documents or non-zero entries, whichever is first, and
# has at most this many pairs of a ball and a term: leaves hold more where terms are many.
TREE_DOCS = 1 << 13
TREE_ENTRIES = 1 << 20
TREE_CELLS = 1 << 22
# Queries are answered in blocks of about this many bytes of text.
QUERY_BYTES = 1 << 18
SKETCH = 64

# Letters, digits and all bytes beyond ASCII are kept, A to Z in lower case.
_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM[0x30:0x3A] = np.arange(0x30, 0x3A)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms_of(texts: pa.Array | pa.ChunkedArray) -> Words:
    """Terms of a batch of texts, named by 64-bit hashes."""
    data, places = text_bytes(texts)
    return words_of(pa.LargeStringArray.from_buffers(
        len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(_TERM[data])
    ))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term occurring ``tf`` times adds to a document of ``n`` terms, per weight."""
    m = 75 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(vocabulary: np.ndarray):
    """Each document's number of terms, and place and count of those the queries hold."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                words, n = terms_of(part.column("text")), part.num_rows
                at = np.minimum(np.searchsorted(vocabulary, words.name), max(len(vocabulary) - 1, 0))
                hit = vocabulary[at] == words.name if len(vocabulary) else np.zeros(len(at), bool)
                keys, _, tf = ranks(words.row[hit].astype(np.int64) * max(len(vocabulary), 1) + at[hit])
                row, term = np.divmod(keys, max(len(vocabulary), 1))
                ends = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(words.count().astype(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64))),
                    ],
                    ["doc_id", "n_terms", "terms", "tf"],
                )

    return run


def _holders(size: int):
    """In how many documents of a task each term occurs."""

    def run(batches):
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(found[used])], ["term", "df"])

    return run


class Tree:
    """A ball tree over rows ``first[i]:first[i + 1]`` of the entries ``(term, impact)``."""

    def __init__(self, first: np.ndarray, term: np.ndarray, impact: np.ndarray, leaf_docs: int = LEAF_DOCS):
        n = len(first) - 1
        sizes = np.diff(first)
        self.known, local = np.unique(term, return_inverse=True)
        leaves = min(n / leaf_docs, TREE_CELLS / 2 / max(len(self.known), 1))
        levels = math.ceil(math.log2(max(leaves, 1)))
        bounds = [0, n]
        row = np.repeat(np.arange(n), sizes)
        # Pivots are compared in a sketch of the vectors; it decides the shape of the tree only.
        spot = mix(term.astype(np.uint64) + np.uint64(11))
        value = np.where(spot & np.uint64(1 << 40), impact, -impact) / 1e6
        sketch = np.bincount(row * SKETCH + (spot % np.uint64(SKETCH)).astype(np.int64), value, n * SKETCH)
        sketch = sketch.reshape(n, SKETCH).astype(np.float32)
        order = np.arange(n)
        for _ in range(levels):
            cut = [0]
            for a, b in zip(bounds, bounds[1:]):
                order[a:b] = order[a:b][_halved(sketch[order[a:b]])]
                cut += [(a + b) // 2, b]
            bounds = cut
        self.order = order
        self.levels = levels
        # Entries in tree order.
        self.first = np.r_[0, np.cumsum(sizes[order])]
        take = np.repeat(first[:-1][order] - self.first[:-1], sizes[order]) + np.arange(len(term))
        self.term, self.impact = local[take], impact[take]
        self.bounds = np.array(bounds)
        self._measure(np.repeat(np.arange(n), sizes[order]))

    def _measure(self, row: np.ndarray) -> None:
        """Centroid, radius and greatest entry per term of every ball, leaves last.

        Balls are numbered as in a heap: the children of ball i are 2 i + 1 and 2 i + 2.
        """
        width, leaves = len(self.known), len(self.bounds) - 1
        leaf = np.repeat(np.arange(leaves), np.diff(self.bounds))[row]
        sums = np.bincount(leaf * width + self.term, self.impact, leaves * width).reshape(leaves, width)
        most = np.zeros(leaves * width)
        key = leaf * width + self.term
        by_key = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(key[by_key]) > 0]) if len(key) else np.zeros(0, int)
        if len(key):
            most[key[by_key][heads]] = np.maximum.reduceat(self.impact[by_key], heads)
        most = most.reshape(leaves, width)
        square = np.bincount(row, self.impact.astype(float) ** 2, len(self.first) - 1)
        counts = np.diff(self.bounds).astype(float)
        centroids, reach, radii = [], [], []
        own = leaf
        for _ in range(self.levels + 1):
            middle = sums / np.maximum(counts, 1)[:, None]
            of_row = np.repeat(np.arange(len(counts)), counts.astype(np.int64))
            inner = np.bincount(row, middle.ravel()[own * width + self.term] * self.impact, len(square))
            size = (middle**2).sum(axis=1)
            # The squared distance, and what rounding may have taken from it.
            far = square - 2 * inner + size[of_row] + 1e-9 * (square + size[of_row])
            radius = np.zeros(len(counts))
            np.maximum.at(radius, of_row, far)
            centroids.insert(0, middle)
            reach.insert(0, most)
            radii.insert(0, np.sqrt(np.maximum(radius, 0)))
            sums, counts = sums[::2] + sums[1::2] if len(sums) > 1 else sums, (
                counts[::2] + counts[1::2] if len(counts) > 1 else counts
            )
            most = np.maximum(most[::2], most[1::2]) if len(most) > 1 else most
            own = own // 2
        # A row per term: a query reads only the rows of its own terms.
        self.centroids = np.ascontiguousarray(np.concatenate(centroids).T)
        self.reach = np.ascontiguousarray(np.concatenate(reach).T)
        self.radii = np.concatenate(radii)

    def upper_bounds(self, place: np.ndarray, q: np.ndarray) -> np.ndarray:
        """For every ball, a number that no score of its documents exceeds."""
        q = q.astype(float)
        ball = q @ self.centroids[place] + math.sqrt(float(q @ q)) * self.radii
        return np.minimum(ball, q @ self.reach[place]) * (1 + 1e-9) + 1

    def search(self, terms: np.ndarray, q: np.ndarray, best: "Best") -> int:
        """Adds what scores to ``best``; gives the number of documents scored."""
        at = np.searchsorted(self.known, terms)
        here = at < len(self.known)
        here[here] = self.known[at[here]] == terms[here]
        if not here.any():
            return 0
        place, q = at[here], q[here]
        upper = self.upper_bounds(place, q).tolist()
        dense = np.zeros(len(self.known), np.int64)
        dense[place] = q
        inner, scored = (1 << self.levels) - 1, 0
        heap = [(-upper[0], 0)]
        while heap and -heap[0][0] >= best.least:
            ball = heapq.heappop(heap)[1]
            if ball < inner:
                for child in (2 * ball + 1, 2 * ball + 2):
                    if upper[child] >= best.least:
                        heapq.heappush(heap, (-upper[child], child))
                continue
            a, b = self.bounds[ball - inner], self.bounds[ball - inner + 1]
            if a == b:
                continue
            low, high = self.first[a], self.first[b]
            products = dense[self.term[low:high]] * self.impact[low:high]
            scores = np.add.reduceat(products, self.first[a:b] - low)
            scored += int(b - a)
            good = np.flatnonzero(scores >= best.least)
            if len(good):
                best.add(scores[good], self.order[a + good])
        return scored


def _halved(points: np.ndarray) -> np.ndarray:
    """An order of points in which those nearer to one of two far pivots come first."""
    far = points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    other = points[((points - far) ** 2).sum(axis=1).argmax()]
    return np.argsort(points @ (other - far), kind="stable")


class Best:
    """The ``top`` best documents of a query so far: by score, then by id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        # Nothing that scores less can still be among them; scores of 0 never are.
        self.least = 1
        self._ids = self._null = None

    def over(self, ids: np.ndarray, null: np.ndarray) -> None:
        """The ids that rows added from now on refer to."""
        self._ids, self._null = ids, null

    def add(self, scores: np.ndarray, rows: np.ndarray) -> None:
        self.scores = np.r_[self.scores, scores]
        self.ids = np.r_[self.ids, self._ids[rows]]
        self.null = np.r_[self.null, self._null[rows]]
        order = np.lexsort((self.ids, self.null, -self.scores))[: self.top]
        self.scores, self.ids, self.null = self.scores[order], self.ids[order], self.null[order]
        if len(order) == self.top:
            self.least = max(1, int(self.scores[-1]))


def _searches(queries: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, top: int):
    """Answers all queries over the documents a task reads; one list per query and task."""

    def run(batches):
        best = [Best(top) for _ in queries]
        waiting: list[pa.RecordBatch] = []
        docs = entries = 0

        def settle_waiting():
            table = pa.Table.from_batches(waiting)
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tf"))
            first = np.r_[0, np.cumsum(table.column("sizes").to_numpy())]
            n = np.repeat(table.column("n_terms").to_numpy(), np.diff(first))
            impact = impacts(tfs.flatten().to_numpy(), n, n_docs, n_terms)
            tree = Tree(first, terms.flatten().to_numpy(), impact)
            ids = table.column("doc_id")
            null = ids.is_null().to_numpy()
            ids = ids.fill_null(0).to_numpy()
            for (own, q), found in zip(queries, best):
                found.over(ids, null)
                tree.search(own, q, found)

        for batch in batches:
            batch = batch.append_column("sizes", pc.list_value_length(batch.column("terms")))
            sizes = np.cumsum(batch.column("sizes").to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                room = int(np.searchsorted(sizes, before + TREE_ENTRIES - entries, "right"))
                to = min(max(at + 1, min(room, at + TREE_DOCS - docs)), batch.num_rows)
                waiting.append(batch.slice(at, to - at))
                docs, entries = docs + to - at, entries + int(sizes[to - 1]) - before
                at = to
                if docs >= TREE_DOCS or entries >= TREE_ENTRIES or at < batch.num_rows:
                    settle_waiting()
                    waiting, docs, entries = [], 0, 0
        if waiting:
            settle_waiting()
        for query, found in enumerate(best):
            if len(found.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.scores), query, np.int32)),
                        pa.array(found.ids, pa.int64(), mask=found.null), pa.array(found.scores),
                    ],
                    ["query", "doc_id", "score"],
                )

    return run


def _block_of_queries(rows) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    words = terms_of(pa.array([r["text"] for r in rows], pa.string()))
    terms, counts = [], []
    for a, b in zip(words.first, words.first[1:]):
        own, _, n = ranks(words.name[a:b])
        terms.append(own)
        counts.append(n)
    return [r["item_id"] for r in rows], terms, counts


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of each item, best first.

    Terms, weights and scores are integers as the query's contract states; equal scores go
    by ``doc_id``, null last. Rows that repeat a ``doc_id`` are documents of their own. Rows
    that repeat an ``item_id`` are one item with the terms of all its different texts. A
    null or empty text has no terms: such a document counts nowhere, such an item has no
    rows. Documents are read once for each ``QUERY_BYTES`` of items, whose texts reach every
    task; all else that is sent is one list of ``top`` documents per item and task.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    queries = keep(
        items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
        .groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), "\n").alias("text"))
    )
    size = queries.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    found = None
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        ids, terms, counts = _block_of_queries(mine.orderBy("item_id").collect())
        vocabulary = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
        vectors = keep(texts.mapInArrow(
            _vectors(vocabulary), "doc_id long, n_terms long, terms array<int>, tf array<long>"
        ))
        n_docs, n_terms = vectors.where("n_terms > 0").agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        # One row per term of the block's items.
        holders = vectors.select("terms").mapInArrow(_holders(len(vocabulary)), "term int, df long")
        df = {r["term"]: r["df"] for r in holders.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = np.array([weight(df.get(t, 0), n_docs) for t in range(len(vocabulary))], np.int64)
        asked = []
        for own, n in zip(terms, counts):
            place = np.searchsorted(vocabulary, own)
            asked.append((place, weights[place] * n))
        names = spark.createDataFrame(list(enumerate(ids)), "query int, item_id long")
        part = (
            vectors.where(F.size("terms") > 0)
            .mapInArrow(_searches(asked, n_docs, n_terms, top), "query int, doc_id long, score long")
            .join(F.broadcast(names), "query").select("item_id", "doc_id", "score")
        )
        found = part if found is None else found.union(part)
    # Lists of many tasks are merged in groups before they meet.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    few = found.withColumn("_group", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    few = few.withColumn("_place", F.row_number().over(Window.partitionBy("item_id", "_group").orderBy(*order)))
    few = few.where(F.col("_place") <= top).select("item_id", "doc_id", "score")
    return (
        few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
        .where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
    )
