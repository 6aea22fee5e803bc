"""Text to token ids and back: vocabulary, length cap, padding, labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructType

from sftprep.functions import LETTER_CLASS, SPACES, pieces
from sftprep.session import settle, ship, small_batches

# Special tokens and the ids they hold.
SPECIALS = ("<unk>", "<s>", "</s>")
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
# Ids 3 to 258 stand for the 256 bytes; pieces and characters follow.
FIRST_BYTE, BYTES = len(SPECIALS), 256
FIRST_PIECE = FIRST_BYTE + BYTES
IGNORED_LABEL = -100
MAX_LENGTH = 512
# Elements of lists that a worker looks up at a time.
PART = 1 << 20
# A join's block holds at most 2 to this many rows; it is what a worker holds at a time.
BLOCK_BITS = 9
# Characters of a text that are cut first for each piece wanted.
PIECE_CHARACTERS = 6


class Vocabulary:
    """A settled table ``(token_id, piece)`` with ids 0..size-1 and no gaps.

    A piece outside it is spelled by its characters, and a character outside it by its
    bytes, so every text has ids and no id is ever unknown.
    """

    def __init__(self, table: DataFrame):
        self.table = table

    @cached_property
    def size(self) -> int:
        return self.table.count()

    @cached_property
    def shipped(self) -> Broadcast | None:
        """The pieces in id order on every executor, or None when too large."""
        table = ship(self.table.select("token_id", "piece"), ("piece",))
        if table is None:
            return None
        ordered = table.sort_by("token_id").column("piece").combine_chunks()
        return self.table.sparkSession.sparkContext.broadcast(ordered)

    @cached_property
    def characters(self) -> Broadcast:
        """Ids of the single characters on every executor; at most as many as Unicode has."""
        rows = self.table.where(F.length("piece") == 1).select("piece", "token_id").toArrow()
        known = dict(zip(rows.column("piece").to_pylist(), rows.column("token_id").to_pylist()))
        return self.table.sparkSession.sparkContext.broadcast(known)


# What ``character_kinds`` found, by application.
_KINDS: dict[str, Broadcast] = {}


def character_kinds(spark: SparkSession) -> Broadcast:
    """Of each code point: 1 if it is a letter of a piece, 2 if it is a space that a piece may
    begin with, else 0. Spark says which are letters, so pieces are those of its own pattern."""
    application = spark.sparkContext.applicationId
    if application in _KINDS:
        return _KINDS[application]
    points = spark.range(0, 0x110000, 1, 8).where(~F.col("id").between(0xD800, 0xDFFF))
    named = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    letters = points.where(named.rlike(f"^{LETTER_CLASS}$")).toArrow().column("id").to_numpy()
    kinds = np.zeros(0x110000, np.uint8)
    kinds[letters] = 1
    kinds[[ord(c) for c in SPACES]] = 2
    _KINDS.clear()
    _KINDS[application] = spark.sparkContext.broadcast(kinds)
    return _KINDS[application]


def text_bounds(texts: pa.Array) -> np.ndarray:
    """Where the bytes of each text begin, and where the last one's end."""
    import numpy as np
    import pyarrow as pa

    if not len(texts):
        return np.zeros(1, np.int32)
    kind = np.dtype(np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, kind.itemsize * texts.offset)


def code_points(texts: pa.Array) -> np.ndarray:
    """Of all characters of some texts, in order."""
    import numpy as np

    bounds = text_bounds(texts)
    first, size = int(bounds[0]), int(bounds[-1] - bounds[0])
    text = texts.buffers()[2].slice(first, size).to_pybytes().decode() if size else ""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def cut(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pieces of some texts, and where each text's begin: what ``pieces`` gives.

    A character begins a piece unless it is a letter that follows a letter or a space.
    """
    import numpy as np
    import pyarrow as pa

    bounds = text_bounds(texts)
    first, size = int(bounds[0]), int(bounds[-1] - bounds[0])
    if not size:
        return pa.array([], pa.string()), np.zeros(len(bounds), np.int64)
    data = texts.buffers()[2].slice(first, size)
    raw = np.frombuffer(data, np.uint8)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    kind = kinds[code_points(texts)]
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[1:] != 1) | (kind[:-1] == 0)
    rows = np.searchsorted(heads, bounds - first)
    begins[rows[rows < len(kind)]] = True
    at = np.flatnonzero(begins)
    ends = np.append(heads[at], size).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), data), np.searchsorted(at, rows)


def piece_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each piece occurs; counted map-side before the shuffle."""
    return (
        df.select(F.explode(pieces(text)).alias("piece"))
        .groupBy("piece")
        .agg(F.count("*").alias("n"))
    )


def piece_counts_by_batch(df: DataFrame, text: str = "text") -> DataFrame:
    """``piece_counts`` of a corpus: no row per piece is made, for each Arrow batch is cut and
    counted where it lies."""
    small_batches(df.sparkSession)
    kinds = character_kinds(df.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for part in parts_of(texts, text_bounds(texts)):
                counts = cut(part, kinds.value)[0].value_counts()
                yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["piece", "n"])

    texts = df.select(F.make_valid_utf8(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    return texts.mapInArrow(counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def build_vocab(df: DataFrame, k: int = 8192, text: str = "text") -> Vocabulary:
    """Special tokens, the 256 bytes, the ``k`` most frequent pieces (ties by piece), and
    the characters of all other pieces in their own order.

    Characters are taken from distinct pieces; there are at most as many as Unicode has.
    """
    spark = df.sparkSession
    counts = settle(piece_counts_by_batch(df, text))
    order = (F.desc("n"), F.asc("piece"))
    # The unpartitioned windows rank at most k pieces, and the characters of a corpus.
    top = counts.orderBy(*order).limit(k).select(
        F.row_number().over(Window.orderBy(*order)).alias("place"), "piece"
    )
    characters = counts.select(F.explode(F.split("piece", "")).alias("piece")).distinct()
    others = (
        characters.where("piece <> ''").join(top.select("piece"), "piece", "left_anti")
        .select(F.row_number().over(Window.orderBy("piece")).alias("place"), "piece")
    )
    known = settle(top.withColumn("kind", F.lit(0)).union(others.withColumn("kind", F.lit(1))))
    n_top = known.where("kind = 0").count()
    fixed = [*SPECIALS, *(f"<0x{b:02X}>" for b in range(BYTES))]
    specials = spark.createDataFrame(list(enumerate(fixed)), "token_id int, piece string")
    pieces_and_characters = known.select(
        (F.col("place") + F.col("kind") * n_top + FIRST_PIECE - 1).cast("int").alias("token_id"), "piece"
    )
    return Vocabulary(settle(specials.union(pieces_and_characters).coalesce(1)))


def with_pieces(df: DataFrame, text: str = "text", out: str = "pieces") -> DataFrame:
    return df.withColumn(out, pieces(text))


def truncate(
    df: DataFrame, max_length: int = MAX_LENGTH, specials: int = 2, col: str = "pieces"
) -> DataFrame:
    """Drop pieces beyond the cap, leaving room for the special tokens.

    Runs on pieces, before ids are looked up, so the dropped tail costs nothing. Each
    piece has at least one id, so what is left still covers the cap.
    """
    return df.withColumn(col, F.slice(col, 1, max(max_length - specials, 0)))


def with_first_pieces(df: DataFrame, most: int, text: str = "text", out: str = "pieces") -> DataFrame:
    """The first ``most`` pieces of each text, without cutting all of it.

    All pieces but the last of a prefix are pieces of the text, so a prefix of more than
    ``most`` pieces will do; other texts are cut whole.
    """
    characters = F.lit(most * PIECE_CHARACTERS)
    enough = (F.size("_cut") > most) | (F.length(text) <= characters)
    df = df.withColumn("_cut", pieces(F.left(F.col(text), characters)))
    return df.withColumn(out, F.slice(F.when(enough, F.col("_cut")).otherwise(pieces(text)), 1, most)).drop("_cut")


def spelled_out(names: pa.Array, find: Callable[[list[str]], list[int | None]]) -> pa.Array:
    """Ids of pieces outside the vocabulary: their characters, or else the characters' bytes.

    ``find`` gives the ids of characters; it is asked once for each that occurs.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    points = code_points(names)
    place = np.bincount(points) if len(points) else np.zeros(1, np.int64)
    letters = np.flatnonzero(place)
    place[letters] = np.arange(len(letters))
    characters = [chr(c) for c in letters]
    each = [
        [FIRST_BYTE + b for b in c.encode()] if i is None else [i] for c, i in zip(characters, find(characters))
    ]
    starts = np.append(0, np.cumsum(pc.utf8_length(names).to_numpy()))
    return _ids_of(starts, pa.array(place[points]), pa.array(each, pa.list_(pa.int32())))


def in_parts(lists: pa.Array, work: Callable[[pa.Array], pa.Array], kind: pa.DataType, most: int = PART) -> pa.Array:
    """``work`` on parts of about ``most`` elements, one list at least: an Arrow batch is
    bounded in rows, not in bytes, and what a step sets aside should not grow with it."""
    parts = [work(part) for part in parts_of(lists, lists.offsets.to_numpy(), most)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def parts_of(rows: pa.Array, bounds: np.ndarray, most: int = PART) -> Iterator[pa.Array]:
    """Slices of ``rows`` of about ``most`` elements, one row at least; ``bounds`` says where
    the elements of each row begin."""
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(bounds, int(bounds[at]) + most, "right")) - 1)
        to = min(to, len(rows))
        yield rows.slice(at, to - at)
        at = to


def _lookup(shipped: Broadcast, kinds: Broadcast | None = None):
    """Ids of lists of pieces or, with the ``kinds`` of characters, of whole texts."""

    # Each part builds its index of the vocabulary anew, so parts are no smaller than that.
    @arrow_udf("array<int>")
    def ids(lists: pa.Array) -> pa.Array:
        import pyarrow as pa

        return in_parts(lists, listed, pa.list_(pa.int32()), max(PART, len(shipped.value)))

    @arrow_udf("array<int>")
    def ids_of_texts(texts: pa.Array) -> pa.Array:
        import pyarrow as pa

        most = max(PART, PIECE_CHARACTERS * len(shipped.value))
        parts = [found_in(*cut(part, kinds.value)) for part in parts_of(texts, text_bounds(texts), most)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def listed(lists: pa.Array) -> pa.Array:
        return found_in(lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py())

    def found_in(flat: pa.Array, starts: np.ndarray) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        found = pc.index_in(flat, value_set=shipped.value)
        if not found.null_count:
            return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), found.cast(pa.int32()))
        # Distinct pieces without an id are spelled once for the whole batch.
        rare = pc.filter(flat, pc.is_null(found)).dictionary_encode()
        spelled = spelled_out(
            rare.dictionary, lambda c: pc.index_in(pa.array(c, pa.string()), value_set=shipped.value).to_pylist()
        )
        sizes = pc.list_value_length(spelled).to_numpy()
        begins = np.cumsum(sizes) - sizes
        rare = rare.indices.to_numpy()
        missing = pc.is_null(found).to_numpy(zero_copy_only=False)
        each = np.ones(len(flat), np.int64)
        each[missing] = sizes[rare]
        ends = np.cumsum(each)
        out = np.empty(int(ends[-1]), np.int32)
        out[(ends - 1)[~missing]] = pc.drop_null(found).to_numpy()
        counts = sizes[rare]
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        spelled = spelled.flatten().to_numpy()
        out[np.repeat((ends - each)[missing], counts) + steps] = spelled[np.repeat(begins[rare], counts) + steps]
        bounds = np.append(0, ends)[starts]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(out))

    # Not to be moved or repeated: a filter on its ids would else look them up once more.
    return (ids if kinds is None else ids_of_texts).asNondeterministic()


def join_frequent(
    tokens: DataFrame, table: DataFrame, on: str, by: tuple[str, ...] = ("_row", "_pos"), how: str = "inner"
) -> DataFrame:
    """Joins ``tokens`` with the one row of ``table`` per ``on``.

    A key that holds more than a shuffle partition's share of all tokens is dealt, by a
    hash of the columns ``by``, over as many copies as it has shares. There are fewer such
    keys than partitions, and all copies together are at most twice as many, so the table
    grows by no more than that.
    """
    shares = max(1, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = settle(tokens.groupBy(on).agg(F.count("*").alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    frequent = F.broadcast(
        counts.where(F.col("_n") * shares > total)
        .select(on, F.ceil(F.col("_n") * shares / F.lit(max(total, 1))).cast("int").alias("_copies"))
    )
    copies = F.coalesce("_copies", F.lit(1))
    dealt = tokens.join(frequent, on, "left").withColumn("_salt", F.pmod(F.hash(*by), copies))
    copied = table.join(frequent, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.drop("_copies").join(copied.drop("_copies"), [on, "_salt"], how).drop("_salt")


def in_blocks(df: DataFrame, col: str, on: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_block``, a number that a few neighbouring rows share, and the distinct
    elements of ``col`` in each block, ``_block, on``.

    Rows keep their own place, so ids may repeat or be null and copies of a text are in as
    many blocks as they fill. A block's elements repeat, so what joins look up is a fraction
    of all elements.
    """
    rows = settle(df.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)))
    used = rows.select("_block", F.explode(col).alias(on)).where(F.col(on).isNotNull())
    return rows, settle(used.distinct())


def found_by_block(
    rows: DataFrame, used: DataFrame, table: DataFrame, on: str, kind: DataType, keep: list[str],
    listed: Callable[[pa.Table], tuple[pa.Array, np.ndarray]],
    gather: Callable[[np.ndarray, pa.Array, pa.Table], pa.Array],
) -> DataFrame:
    """The columns ``keep`` of ``rows``, and ``_found``: what ``gather`` makes of their lists.

    Only the elements of a block, ``used (_block, on)``, meet the ``table (on, value)``, which
    has one row per element. What is found then meets the block's rows, which move once.
    ``listed`` gives the elements of a block's rows and where each row's begin; ``gather``
    gets where each row's known elements begin, their places among the block's, and those
    with their values. An element that is null or not among the block's is left out.
    """
    found = join_frequent(used, table, on, by=("_block",), how="left").select("_block", on, "value")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow.compute as pc

        flat, begins = listed(left)
        right = right.combine_chunks()
        places = pc.index_in(flat, value_set=pc.drop_null(right.column(on).combine_chunks()))
        before = np.append(0, np.cumsum(pc.is_valid(places).to_numpy(zero_copy_only=False)))
        return left.select(keep).append_column("_found", gather(before[begins], pc.drop_null(places), right))

    schema = StructType([rows.schema[c] for c in keep]).add("_found", kind)
    return rows.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(work, schema)


def _begins(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _ids_of(starts, places: pa.Array, parts: pa.Array) -> pa.Array:
    """The lists that the parts at ``places`` make."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = parts.take(places)
    ends = np.append(0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), ids.flatten())


def ids_by_join(
    df: DataFrame, table: Callable[[DataFrame], DataFrame], col: str, out: str,
    find: Callable[[list[str]], list[int | None]] | None = None,
) -> DataFrame:
    """Ids by a join with ``table(used)``, ``piece, ids`` of the pieces in ``used (piece)``;
    takes ``col`` away. Pieces without ids are spelled by ``find``, where they are found."""
    rows, used = in_blocks(df.withColumn(col, F.array_compact(col)), col, "piece")
    keep = [c for c in df.columns if c not in (col, out)]
    # A text and the sizes of its pieces are a third of a list of pieces.
    moved = rows.select(
        *keep, "_block", F.array_join(col, "").alias("_text"), F.transform(col, F.octet_length).alias("_sizes")
    )

    def listed(left: pa.Table) -> tuple[pa.Array, np.ndarray]:
        import numpy as np
        import pyarrow as pa

        lists = left.column("_sizes").combine_chunks()
        ends = np.append(0, np.cumsum(lists.flatten().to_numpy())).astype(np.int32)
        text = "".join(t or "" for t in left.column("_text").to_pylist()).encode()
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(text)), _begins(lists)

    def gather(starts, places: pa.Array, right: pa.Table) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names, ids = (right.column(c).combine_chunks() for c in ("piece", "value"))
        if find is not None and ids.null_count:
            rare = pc.is_null(ids)
            at = np.where(rare, np.cumsum(rare) - 1 + len(ids), np.arange(len(ids)))
            ids = pa.concat_arrays([ids, spelled_out(names.filter(rare), find).cast(ids.type)]).take(pa.array(at))
        return _ids_of(starts, places, ids)

    valued = table(used.select("piece")).select("piece", F.col("ids").alias("value"))
    both = found_by_block(moved, used, valued, "piece", ArrayType(IntegerType()), keep, listed, gather)
    return both.withColumnRenamed("_found", out)


def encode(
    df: DataFrame,
    vocab: Vocabulary,
    key: str | None = None,
    text: str = "text",
    add_bos: bool = True,
    add_eos: bool = True,
    via: str = "auto",
    max_length: int | None = None,
) -> DataFrame:
    """Adds ``input_ids``. Uses column ``pieces`` when present, else cuts ``text``.

    A vocabulary under the shipping limits is looked up inside each Arrow batch: no
    row moves. A larger one is joined by piece. Both keep every row, whether or not its
    ``key`` is null or repeats. ``max_length`` counts the special tokens.
    """
    shipped = None if via == "join" else vocab.shipped
    if shipped is not None:
        small_batches(df.sparkSession)
        if "pieces" in df.columns:
            ids = _lookup(shipped)("pieces")
        else:
            # Whole texts are cut where they are looked up.
            whole = F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))
            ids = _lookup(shipped, character_kinds(df.sparkSession))(whole)
        df = df.withColumn("input_ids", ids)
    else:
        if "pieces" not in df.columns:
            df = with_pieces(df, text)
        known = vocab.table.select("piece", F.array("token_id").alias("ids"))
        characters = vocab.characters

        def find(letters: list[str]) -> list[int | None]:
            return [characters.value.get(c) for c in letters]

        df = ids_by_join(df, lambda used: known, "pieces", "input_ids", find)
    if max_length is not None:
        room = max(max_length - int(add_bos) - int(add_eos), 0)
        df = df.withColumn("input_ids", F.slice("input_ids", 1, room))
    if add_bos or add_eos:
        bos = [F.array(F.lit(BOS_ID))] if add_bos else []
        eos = [F.array(F.lit(EOS_ID))] if add_eos else []
        df = df.withColumn("input_ids", F.concat(*bos, "input_ids", *eos))
    return df.drop("pieces")


def with_length(df: DataFrame, ids: str = "input_ids", out: str = "length") -> DataFrame:
    return df.withColumn(out, F.size(ids))


def tokenize(
    df: DataFrame,
    vocab: Vocabulary,
    max_length: int | None = MAX_LENGTH,
    key: str | None = None,
    text: str = "text",
    add_bos: bool = True,
    add_eos: bool = True,
    via: str = "auto",
) -> DataFrame:
    """One tokenizer call: ``input_ids``, ``attention_mask`` and ``length``."""
    specials = int(add_bos) + int(add_eos)
    if max_length is None:
        df = df.drop("pieces")
    else:
        df = with_first_pieces(df, max(max_length - specials, 0), text)
    df = encode(df, vocab, key, text, add_bos, add_eos, via, max_length)
    df = with_length(df)
    return df.withColumn("attention_mask", F.array_repeat(F.lit(1), F.col("length")))


def pad_batch(
    df: DataFrame,
    by: str | list[str] = "batch_id",
    pad_id: int = UNK_ID,
    width: Column | str | None = None,
) -> DataFrame:
    """Right-pads ids to the longest row of the batch; mask 1 is a real token.

    Pass ``width`` when the batch plan already knows it: padding then moves no rows.
    """
    if width is None:
        keys = [by] if isinstance(by, str) else by
        width = F.max(F.size("input_ids")).over(Window.partitionBy(*keys))
    elif isinstance(width, str):
        width = F.col(width)
    size = F.size("input_ids")
    return (
        df.withColumn("_width", width)
        .withColumn(
            "attention_mask",
            F.concat(
                F.array_repeat(F.lit(1), size), F.array_repeat(F.lit(0), F.col("_width") - size)
            ),
        )
        .withColumn(
            "input_ids",
            F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("_width") - size)),
        )
        .drop("_width")
    )


def causal_labels(df: DataFrame, pad_id: int = UNK_ID, out: str = "labels") -> DataFrame:
    """Labels are the ids with every pad id ignored.

    Masks by id, not by attention mask. The pad id is the unknown id by default; encoding
    never gives a text that id.
    """
    ignored = F.lit(IGNORED_LABEL)
    return df.withColumn(
        out, F.transform("input_ids", lambda i: F.when(i == pad_id, ignored).otherwise(i))
    )


def only_full_length(df: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Keeps rows that reach the cap exactly. Off in every flow by default."""
    return df.where(F.col("length") == max_length)


def _spell(shipped: Broadcast, first_id: int):
    @arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        import pyarrow as pa

        return in_parts(lists, part, pa.string(), max(PART, len(shipped.value)))

    def part(lists: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        flat = lists.flatten()
        names = shipped.value
        kept = pc.and_(pc.greater_equal(flat, first_id), pc.less(flat, len(names)))
        whole = pa.concat_arrays([
            names[:FIRST_BYTE].cast(pa.binary()), pa.array([bytes([b]) for b in range(BYTES)], pa.binary()),
            names[FIRST_PIECE:].cast(pa.binary()),
        ])
        words = whole.take(pc.filter(flat, kept))
        # New offsets: how many kept ids precede each list.
        before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
        starts = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        rows = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)
        joined = pc.binary_join(rows, b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # drawn ids need not spell whole characters
            texts = [None if t is None else t.decode("utf-8", "replace") for t in joined.to_pylist()]
            return pa.array(texts, pa.string())

    return text


def decode(
    df: DataFrame,
    vocab: Vocabulary,
    key: str | None = None,
    ids: str = "input_ids",
    out: str = "decoded",
    skip_special: bool = True,
    via: str = "auto",
) -> DataFrame:
    """Adds the text the ids spell; special tokens are left out unless asked for.

    Bytes that spell no character read as U+FFFD.
    """
    first_id = len(SPECIALS) if skip_special else 0
    shipped = None if via == "join" else vocab.shipped
    if shipped is not None:
        small_batches(df.sparkSession)
        return df.withColumn(out, _spell(shipped, first_id)(ids))
    is_byte = F.col("token_id").between(FIRST_BYTE, FIRST_PIECE - 1)
    spelled = F.when(is_byte, F.unhex(F.substr("piece", F.lit(4), F.lit(2)))).otherwise(F.encode("piece", "utf-8"))
    table = vocab.table.where(F.col("token_id") >= first_id).select("token_id", spelled.alias("value"))
    rows, used = in_blocks(df, ids, "token_id")

    def listed(left: pa.Table) -> tuple[pa.Array, np.ndarray]:
        lists = left.column(ids).combine_chunks()
        return lists.flatten(), _begins(lists)

    def gather(starts, places: pa.Array, right: pa.Table) -> pa.Array:
        import pyarrow as pa
        import pyarrow.compute as pc

        values = pc.fill_null(right.column("value").combine_chunks(), b"")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values.take(places)), b"")

    found = found_by_block(rows, used, table, "token_id", BinaryType(), df.columns, listed, gather)
    found = found.withColumnRenamed("_found", "_bytes")
    read = F.make_valid_utf8(F.col("_bytes").cast("string"))
    return found.withColumn(out, F.when(F.col(ids).isNotNull(), read)).drop("_bytes")
