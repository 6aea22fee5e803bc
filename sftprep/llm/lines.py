"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions alone.

Two lines are near when one unit inserted, deleted or replaced turns one into the other.
The units of a line of many words are its words; a line of few words, or one written
without spaces, is compared by characters. Every line that could be near another emits
the keys of all its variants with one unit deleted. Equal keys at the same place are replacements; a variant key equal to the key
of a whole line is a deletion. Each key group is a star around its earliest line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.llm.store import keep, single_spaced, texts_of

# Lines of fewer words are compared by characters: one word of a few is too much.
LEAST_WORDS = 8
# One character may differ in lines of this many characters; shorter ones must be equal.
LEAST_LETTERS = 16
_PRIME = (1 << 31) - 1


def _weight(unit: Column, place: Column, seed: int) -> Column:
    """What a unit adds to the key of a line when it stands at ``place``."""
    value = F.pmod(F.xxhash64(unit, F.lit(seed)), F.lit(_PRIME))
    factor = F.pmod(F.xxhash64(place, F.lit(seed + 100)), F.lit(_PRIME))
    return F.pmod(value * factor, F.lit(_PRIME))


def _halves(line: str, by_words: Column, size: Column) -> Column:
    """Keys of the leading and trailing halves of a line with single spaces.

    One edit leaves the first or the last half of the shorter line untouched, so near
    lines share a key. The shorter line has as many units as this one, or one fewer.
    """
    keys = []
    for half in (F.floor(size / 2), F.floor((size - 1) / 2)):
        half = half.cast("int")
        for end, letters in (("head", F.left(F.col(line), half)), ("tail", F.right(F.col(line), half))):
            some = half if end == "head" else -half
            words = F.call_function("substring_index", F.col(line), F.lit(" "), some)
            keys.append(F.xxhash64(F.lit(end), by_words, half, F.when(by_words, words).otherwise(letters)))
    return F.array_distinct(F.array(*keys))


def _variants(lines: DataFrame) -> DataFrame:
    """One row per unit: the key of its line without it, and the key of the line itself."""
    units = lines.select(
        "line", "first", "by_words", F.size("units").alias("size"), F.posexplode("units").alias("at", "unit")
    )
    for s in (1, 2):
        units = units.withColumn(f"stay{s}", _weight(F.col("unit"), F.col("at"), s)).withColumn(
            f"move{s}", _weight(F.col("unit"), F.col("at") - 1, s)
        )
    line = Window.partitionBy("line")
    before = line.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    up_to = line.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    for s in (1, 2):
        left = F.coalesce(F.sum(f"stay{s}").over(before), F.lit(0))
        right = F.sum(f"move{s}").over(line) - F.sum(f"move{s}").over(up_to)
        units = units.withColumn(f"key{s}", F.pmod(left + right, F.lit(_PRIME)))
        units = units.withColumn(f"whole{s}", F.pmod(F.sum(f"stay{s}").over(line), F.lit(_PRIME)))
    return units.select("line", "first", "by_words", "size", "at", "key1", "key2", "whole1", "whole2")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether lists of units differ by exactly one replaced, inserted or deleted."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differ, True).cast("int")
    long, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    rest = F.size(short) - at + 1
    shifted = F.slice(long, at + 1, rest) == F.slice(short, at, rest)
    replaced = F.slice(a, at + 1, F.size(a)) == F.slice(b, at + 1, F.size(b))
    return F.when(at == 0, F.lit(False)).when(F.size(a) == F.size(b), replaced).when(
        F.abs(F.size(a) - F.size(b)) == 1, shifted
    ).otherwise(F.lit(False))


def _suspects(firsts: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another: the only ones that can be near."""
    keyed = firsts.select("line", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.min("line").alias("a"), F.max("line").alias("b"))
    shared = shared.where("a <> b").select("half")
    return keyed.join(shared, "half", "left_semi").select("line").distinct()


def near_earlier(suspects: DataFrame) -> DataFrame:
    """``line, near``: lines with an earlier line one unit away, and the earliest linked.

    ``suspects`` has one row per distinct line: ``line`` (key), ``first`` (place, ordered),
    ``by_words`` and ``units``. Links are verified on the units before one is chosen.
    """
    variants = keep(_variants(suspects))
    place = ["by_words", "size", "at", "key1", "key2"]
    stars = variants.groupBy(*place).agg(
        F.min(F.struct("first", "line")).alias("hub"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    replaced = variants.join(stars, place).where("first > hub.first").select(
        "line", F.col("hub.first").alias("near_first"), F.col("hub.line").alias("near")
    )
    whole = variants.where("at = 0").select(
        F.col("line").alias("short"), F.col("first").alias("short_first"), "by_words",
        F.col("whole1").alias("key1"), F.col("whole2").alias("key2"), (F.col("size") + 1).alias("size"),
    )
    deleted = variants.join(whole, ["by_words", "size", "key1", "key2"]).select(
        F.when(F.col("first") > F.col("short_first"), F.col("line")).otherwise(F.col("short")).alias("line"),
        F.least("first", "short_first").alias("near_first"),
        F.when(F.col("first") > F.col("short_first"), F.col("short")).otherwise(F.col("line")).alias("near"),
    )
    links = replaced.union(deleted).distinct()
    own = suspects.select("line", "by_words", F.col("units").alias("own"))
    other = suspects.select(
        F.col("line").alias("near"), F.col("by_words").alias("so"), F.col("units").alias("other")
    )
    verified = links.join(own, "line").join(other, "near").where(
        (F.col("by_words") == F.col("so")) & _one_edit(F.col("own"), F.col("other"))
    )
    return verified.groupBy("line").agg(F.min(F.struct("near_first", "near")).alias("best")).select(
        "line", F.col("best.near").alias("near")
    )


def _cut(texts: DataFrame, *beside: str) -> DataFrame:
    """One row per line that has words: ``doc_id, at, line_text`` with single spaces."""
    spaced = single_spaced(texts, "text", newlines=False)
    lines = spaced.select("doc_id", *beside, F.posexplode(F.split("text", "\n")).alias("at", "line_text"))
    return lines.where("line_text not in ('', ' ')").withColumn("line_text", F.trim("line_text"))


def _key() -> Column:
    return F.unhex(F.md5("line_text")).alias("line")


def _n_words() -> Column:
    """The words of a line with single spaces."""
    return F.octet_length("line_text") - F.octet_length(F.replace("line_text", F.lit(" "), F.lit(""))) + 1


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_letters: int = LEAST_LETTERS,
) -> DataFrame:
    """``doc_id, text, n_lines, n_copies, n_near``: texts without lines seen earlier.

    Lines are cut at newlines and compared as lists of words. A line goes when the same
    words stand in an earlier line (smaller id, or same document and earlier). Of lines
    of ``least_words`` words or more, it also goes when an earlier one is one word away;
    of lines of fewer words but ``least_letters`` characters or more (words joined by one
    space; any length without spaces), when an earlier one is one character away. Lines are judged on the input, not on what is left. Lines without words stay.
    ``n_copies`` counts lines dropped as copies, ``n_near`` the others dropped. Null text
    stays null with no lines. A row without an id stays as it is; rows that repeat an id
    repeat its lines, which count as one. Keys of variants have 62 bits; each link is
    verified on the words or characters.
    """
    texts = texts_of(docs, id_col, text_col)
    cut = _cut(texts.where("doc_id is not null"))
    cut = cut.withColumn("size", _n_words()).withColumn("by_words", F.col("size") >= least_words)
    cut = cut.withColumn("size", F.when(F.col("by_words"), F.col("size")).otherwise(F.char_length("line_text")))
    halves = F.when(
        F.col("by_words") | (F.col("size") >= least_letters),
        _halves("line_text", F.col("by_words"), F.col("size")),
    ).alias("halves")
    places = keep(cut.select("doc_id", "at", _key(), halves))
    firsts = keep(
        places.groupBy("line").agg(
            F.min(F.struct("doc_id", "at")).alias("first"), F.first("halves").alias("halves")
        )
    )
    # The units of a distinct line are those at its first place.
    wanted = (
        firsts.join(_suspects(firsts), "line", "left_semi")
        .groupBy(F.col("first.doc_id").alias("doc_id"))
        .agg(F.collect_list("first.at").alias("wanted"))
    )
    suspects = keep(
        _cut(texts.join(wanted, "doc_id"), "wanted")
        .where(F.array_contains("wanted", F.col("at")))
        .withColumn("by_words", _n_words() >= least_words)
        .select(
            _key(), F.struct("doc_id", "at").alias("first"), "by_words",
            F.when(F.col("by_words"), F.split("line_text", " ")).otherwise(F.split("line_text", "")).alias("units"),
        )
        .dropDuplicates(["line"])
    )
    near = keep(near_earlier(suspects).select("line", F.lit(True).alias("near")))
    judged = (
        places.drop("halves").join(firsts.drop("halves"), "line")
        .join(near, "line", "left")
        .withColumn("copy", F.col("first") < F.struct("doc_id", "at"))
        .where(F.col("copy") | F.col("near"))
        .groupBy("doc_id")
        .agg(
            F.array_sort(F.collect_set("at")).alias("gone"),
            F.countDistinct(F.when(F.col("copy"), F.col("at"))).alias("n_copies"),
            F.countDistinct(F.when(~F.col("copy"), F.col("at"))).alias("n_near"),
        )
    )
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda line, i: ~F.array_contains("gone", i))
    return texts.join(judged, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
