from sftprep.functions.columns import (
    LETTER_CLASS,
    PIECE_PATTERN,
    SPACES,
    pieces,
    shuffle_key,
    truthy,
    uniform,
    words_or_none,
)

__all__ = ["LETTER_CLASS", "PIECE_PATTERN", "SPACES", "pieces", "shuffle_key", "truthy", "uniform", "words_or_none"]
