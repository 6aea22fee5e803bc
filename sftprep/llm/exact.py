"""Exact duplicates by content-defined chunk recipes, in DataFrame functions alone.

A text is cut where its own characters say so; each chunk gets an identifier, and a
document becomes the ordered list of its chunk identifiers. Chunk texts are moved once,
after equal ones have been merged where they lie; from then on only lists are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.llm.store import keep, single_spaced, texts_of

# A chunk ends at the first sentence or clause end after CHUNK_LEAST
# characters and has CHUNK_MOST at most.
CHUNK_LEAST, CHUNK_MOST = 512, 4096


def chunks(text: Column, least: int = CHUNK_LEAST, most: int = CHUNK_MOST) -> Column:
    """Cuts a text losslessly where its content has a mark, within the size bounds."""
    pattern = rf"(?s).{{{least},{most - 2}}}?[.,;:!?] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _clashing(cut: DataFrame) -> DataFrame:
    """Identifiers that two different chunk texts share."""
    texts = cut.select(F.explode("chunks").alias("chunk")).groupBy(
        F.xxhash64("chunk").alias("id"), "chunk"
    ).agg(F.count("*").alias("n"))
    return texts.groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1").select("id")


def _told_apart(cut: DataFrame, clashing: DataFrame) -> DataFrame:
    """Recipes in which clashing chunks carry the number of their text as well."""
    parts = cut.select("row", F.posexplode("chunks").alias("at", "chunk")).withColumn(
        "id", F.xxhash64("chunk")
    )
    order = Window.partitionBy("id").orderBy("chunk")
    numbers = (
        parts.join(clashing, "id", "left_semi").select("id", "chunk").distinct()
        .withColumn("number", F.row_number().over(order))
    )
    piece = F.struct("at", "id", F.coalesce("number", F.lit(0)).alias("number"))
    return parts.join(numbers, ["id", "chunk"], "left").groupBy("row").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces")
    ).select("row", F.expr("flatten(transform(pieces, p -> array(p.id, p.number)))").alias("recipe"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: int = CHUNK_LEAST, most: int = CHUNK_MOST,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row.

    Texts are equal when identical after each run of white space is read as one space;
    null reads as empty. The row with the smallest id of equal texts stays. A null id
    counts in the group and stays only where no row of the group has an id. Rows that
    repeat an id and its text share its fate. An empty table gives an empty result.

    Identifiers are 64-bit hashes that have been verified: the distinct (identifier,
    chunk) pairs of the corpus are grouped, and an identifier that two texts share is
    told apart by a number. Lists are compared as values, never as hashes.
    """
    texts = texts_of(docs, id_col, text_col).na.fill("", ["text"])
    cut = single_spaced(texts, "text")
    cut = cut.withColumn("chunks", chunks(F.col("text"), least, most))
    clashing = keep(_clashing(cut))
    digest = F.sha2("text", 256).alias("text_sha256")
    if clashing.isEmpty():
        listed = cut.select(
            "doc_id", digest, F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe")
        )
    else:
        named = keep(cut.select("doc_id", digest, "chunks").withColumn("row", F.uuid()))
        listed = named.join(_told_apart(named, clashing), "row", "left").select(
            "doc_id", "text_sha256", F.coalesce("recipe", F.expr("array()")).alias("recipe")
        )
    listed = keep(listed)
    groups = listed.groupBy("recipe").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
