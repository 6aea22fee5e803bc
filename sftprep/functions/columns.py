"""Column functions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A run of letters and digits with at most one leading white space, or else any
# single character. Every character belongs to exactly one piece, so joining the
# pieces gives the text back. Scripts without spaces fall to one piece a character.
SPACES = " \t\r\n\u3000"
LETTER_CLASS = r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}\p{M}\p{N}]"
PIECE_PATTERN = rf"[ \t\r\n\x{{3000}}]?{LETTER_CLASS}+|(?s:.)"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c: Column | str) -> Column:
    """True unless the value is null or empty. White space counts as a value."""
    return F.coalesce(_column(c).cast("string"), F.lit("")) != ""


def words_or_none(c: Column | str) -> Column:
    """The value as text; null reads ``None``, as string formatting prints it."""
    return F.coalesce(_column(c).cast("string"), F.lit("None"))


def pieces(c: Column | str) -> Column:
    """Lossless cut of a text into pieces; null gives an empty array."""
    return F.regexp_extract_all(
        F.coalesce(_column(c), F.lit("")), F.lit(PIECE_PATTERN), F.lit(0)
    )


def shuffle_key(seed, *parts: Column | str) -> Column:
    """Uniform 32-digit hex key of a row, repeatable for a seed; null reads as empty."""
    fields = [F.lit(str(seed))]
    for part in parts:
        fields += [F.lit(":"), F.coalesce(_column(part).cast("string"), F.lit(""))]
    return F.md5(F.concat(*fields))


def uniform(seed, *parts: Column | str) -> Column:
    """A number in [0, 1) drawn from the key of a row."""
    return F.conv(F.substring(shuffle_key(seed, *parts), 1, 8), 16, 10).cast("double") / F.lit(
        float(1 << 32)
    )
