"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled and composed once: the normaliser (a space before the text,
spaces as the pieces spell them), the pieces as a byte trie with a weight each, and the
byte fallback. A text is composed with them by following the trie from every place, and
its encoding is the shortest path in the tropical semiring (smallest sum of weights).
No piece spans two neighbouring bytes that no piece contains, so paths are found between
such places, once for each distinct stretch of a batch and for all stretches at once.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from sftprep.llm.store import SLICE_BYTES, byte_slices, slices_by
from sftprep.llm.words import _TABLES, ranks, span_hashes, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Weight of a byte outside all pieces: above any piece, so it is the last resort.
FALLBACK_WEIGHT = 40.0
# Merge ranks are read as Zipf ranks: weight = log(rank + offset).
ZIPF_OFFSET = 3.0
_SPACE, _META = b" ", "▁".encode()
_KEPT: dict[str, Pieces] = {}


class Pieces:
    """The composed machine of one model file, compiled once per process."""

    def __init__(self, model: bytes):
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = source.get_piece_size()
        self.spelled: list[bytes] = [b""] * size
        self.byte_id = np.full(256, -1, np.int32)
        ranked = {}
        for i in range(size):
            if source.is_control(i) or source.is_unknown(i) or source.is_unused(i):
                continue
            piece = source.id_to_piece(i)
            if source.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
            else:
                # A meta symbol in a piece is a space of the text; a text's own meta
                # symbols then match no piece and come back byte by byte.
                self.spelled[i] = piece.encode().replace(_META, _SPACE)
                ranked[self.spelled[i]] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        scores = np.array([source.get_score(i) for i in range(size)])
        weight = np.log(scores.max() - scores + ZIPF_OFFSET).astype(np.float32)
        self.ranked, self.weight = ranked, weight
        lengths = np.array([len(s) for s in self.spelled])
        self.text = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.text_start, self.text_size = np.cumsum(lengths) - lengths, lengths

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Transitions by state and byte, the piece that ends in each state, and which
        bytes stand side by side in some piece. Only encoding needs them."""
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        together = np.zeros((256, 256), bool)
        for spelled, i in self.ranked.items():
            state = 0
            for byte in spelled:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                state = children[state][byte]
            ends[state] = i
            pair = np.frombuffer(spelled, np.uint8)
            together[pair[:-1], pair[1:]] = True
        go = np.zeros((len(children), 256), np.int32)
        for state, out in enumerate(children):
            if out:
                go[state, list(out)] = list(out.values())
        piece = np.full(len(children), -1, np.int32)
        piece[list(ends)] = list(ends.values())
        return go, piece, together

    def shortest(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Piece ids of the shortest path of each stretch, flat, and how many each has.

        Among equal sums the path found first stays: the longest last piece.
        """
        go, ending, _ = self.trie
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        base = np.cumsum(sizes + 1) - (sizes + 1)
        best = np.full(int((sizes + 1).sum()), np.inf, np.float32)
        came = np.zeros(len(best), np.int32)
        by = np.zeros(len(best), np.int32)
        best[base] = 0.0
        for at in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -at, side="left"))
            own, end, byte_at = base[:active] + at, base[:active] + sizes[:active], starts[:active] + at
            byte = data[byte_at]
            cost = best[own] + np.float32(FALLBACK_WEIGHT)
            better = cost < best[own + 1]
            best[own[better] + 1], came[own[better] + 1] = cost[better], at
            by[own[better] + 1] = self.byte_id[byte[better]]
            state, here, depth = go[0, byte], own, 0
            while True:
                alive = state > 0
                if not alive.all():
                    state, here, byte_at, end = state[alive], here[alive], byte_at[alive], end[alive]
                if not len(state):
                    break
                depth += 1
                piece = ending[state]
                some = piece >= 0
                to, found = here[some] + depth, piece[some]
                cost = best[here[some]] + self.weight[found]
                better = cost < best[to]
                to = to[better]
                best[to], came[to], by[to] = cost[better], at, found[better]
                more = here + depth < end
                if not more.all():
                    state, here, byte_at, end = state[more], here[more], byte_at[more], end[more]
                state = go[state, data[byte_at + depth]]
        # Walk all paths back together; pieces come out last first.
        place, which, steps = sizes.copy(), np.arange(len(sizes)), []
        while len(which):
            at = base[which] + place[which]
            steps.append((which, by[at]))
            place[which] = came[at]
            which = which[place[which] > 0]
        counts = np.zeros(len(sizes), np.int64)
        for which, _ in steps:
            counts[which] += 1
        flat_start = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for step, (which, ids) in enumerate(steps):
            flat[flat_start[which] + counts[which] - 1 - step] = ids
        # Back to the order the stretches came in.
        back = np.argsort(order)
        return flat, flat_start[back], counts[back]

    def encode(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's ids begin."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(places), np.int64)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.trie[2][data[:-1], data[1:]]
        cut[places[:-1][places[:-1] < places[1:]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        name = np.empty(len(starts), np.uint64)
        for i in range(0, len(starts), 1 << 13):
            j = min(i + (1 << 13), len(starts))
            values = _TABLES["bytes"][data[starts[i] : ends[j - 1]]]
            name[i:j] = span_hashes(values, starts[i:j] - starts[i], ends[i:j] - starts[i])
        keys, place, _ = ranks(name)
        one = np.zeros(len(keys), np.int64)
        one[place] = np.arange(len(starts))
        flat, flat_start, counts = self.shortest(data, starts[one], (ends - starts)[one])
        each = counts[place]
        before = np.cumsum(each) - each
        ids = flat[np.repeat(flat_start[place] - before, each) + np.arange(int(each.sum()))]
        return ids, np.append(before, len(ids))[np.searchsorted(starts, places)]

    def decode(self, ids: np.ndarray, places: np.ndarray) -> list[str]:
        """The texts that ids spell, without the space the normaliser put first."""
        each = self.text_size[ids]
        before = np.cumsum(each) - each
        total = int(each.sum())
        data = self.text[np.repeat(self.text_start[ids] - before, each) + np.arange(total)].tobytes()
        bounds = np.append(before, total)[places].tolist()
        return [
            data[a + (data[a : a + 1] == _SPACE) : b].decode("utf-8", "replace")
            for a, b in zip(bounds[:-1], bounds[1:])
        ]


def pieces_of(model: bytes) -> Pieces:
    key = hashlib.md5(model).hexdigest()
    if key not in _KEPT:
        _KEPT[key] = Pieces(model)
    return _KEPT[key]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, text_col: str = "text", out: str = "ids", model_path: str = MODEL) -> DataFrame:
    """Adds ``out``, the piece ids of each text. Null and empty texts have none.

    The driver reads the model file, whose size is the vocabulary's, and every task gets
    its bytes. An existing column named ``out`` is replaced.
    """
    df = df.drop(out)
    model = df.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    names = df.columns

    def run(batches):
        machine = pieces_of(model.value)
        for batch in batches:
            for part in byte_slices(batch, text_col):
                texts = part.column(text_col)
                full = pc.if_else(
                    pc.equal(pc.binary_length(texts.fill_null("")), 0), "",
                    pc.binary_join_element_wise(" ", texts.fill_null(""), ""),
                )
                ids, places = machine.encode(*text_bytes(full))
                lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*names, out])

    schema = StructType(list(df.schema.fields)).add(out, ArrayType(IntegerType()))
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", out: str = "decoded", model_path: str = MODEL) -> DataFrame:
    """Adds ``out``, the text that the ids of each row spell; null ids spell an empty text."""
    df = df.drop(out)
    model = df.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    names = df.columns

    def run(batches):
        machine = pieces_of(model.value)
        for batch in batches:
            each = pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0).to_numpy(zero_copy_only=False)
            for part in slices_by(batch, each + 4, SLICE_BYTES // 4):
                lists = part.column(ids_col)
                ids = lists.flatten().to_numpy()
                each = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
                texts = machine.decode(ids, np.r_[0, np.cumsum(each)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*names, out]
                )

    return df.mapInArrow(run, StructType(list(df.schema.fields)).add(out, StringType()))


def round_trip(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL
) -> DataFrame:
    """``doc_id, n_chars, n_tokens, ids_hash, decoded_sha256, exact``, one row per input row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = decode(encode(texts, model_path=model_path), model_path=model_path)
    return both.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )
