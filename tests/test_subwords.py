import base64
import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from sftprep.operators import subwords as S

FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TEXTS = [
    "Hello, world! It's 2024 and we'll see.", "", None, "  two  spaces \n\n\ttabs　wide  ", "日本語のテキスト 😀 é",
    "a" * 3000, "x = [i**2 for i in range(10)]\n", " ", "  don't DON'T", "<|endoftext|> ¿qué? ñandú",
]


@pytest.fixture(scope="module")
def known(spark):
    return S.Subwords(spark, FILE)


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("via", ["auto", "join"])
def test_ids_are_those_of_the_public_library(spark, known, library, documents, via):
    texts = TEXTS + [r["text"] for r in documents.limit(60).collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r for r in S.decode(S.encode(rows, known, via=via), known).collect()}
    for i, text in enumerate(texts):
        assert list(got[i]["input_ids"]) == library.encode_ordinary(text or ""), text
        assert got[i]["decoded"] == (text or "")


def test_merging_is_exact_on_any_bytes(known, library):
    ranks = {t: i for i, t in enumerate(known.tokens)}
    draw = random.Random(4)
    for _ in range(300):
        word = bytes(draw.choices(b"abcdet hnio\xc3\xa9", k=draw.randrange(1, 60)))
        assert S.merged(word, ranks) == library._encode_single_piece(word)


def test_long_words_take_time_in_proportion(known):
    ranks = {t: i for i, t in enumerate(known.tokens)}
    word = bytes(random.Random(2).choices(b"abcdefghijklmnopqrstuvwxyz", k=200_000))
    assert b"".join(known.tokens[i] for i in S.merged(word, ranks)) == word


def test_repeated_rows_and_fewer_ids_than_characters(spark, known, documents):
    rows = documents.union(documents)
    ids = S.encode(rows, known)
    assert ids.count() == rows.count()
    sums = ids.agg(F.sum(F.size("input_ids")), F.sum(F.length("text"))).first()
    assert sums[0] < 0.7 * sums[1]
    assert S.encode(rows.limit(0), known).collect() == []


def test_workers_keep_a_bounded_number_of_words(spark, known):
    """All distinct words were once sent to every worker."""
    import os

    from sftprep.session import new_path

    rows = spark.range(3000).selectExpr("id", "concat(md5(cast(id as string)), ' the ', md5(cast(id as string))) as text")
    folder = new_path(spark, "x").rsplit("/", 1)[0]
    os.makedirs(folder, exist_ok=True)
    n = len(os.listdir(folder))
    ids = S.encode(rows.coalesce(1), known)
    assert len(os.listdir(folder)) == n
    want = S.encode(rows, known, via="join").select("id", "input_ids")
    assert want.exceptAll(ids.select("id", "input_ids")).count() == 0


def test_decode_of_odd_ids(spark, known):
    rows = spark.createDataFrame([([0, -1, None, 10**6],), ([],), (None,), ([94],)], "input_ids array<int>")
    got = [r["decoded"] for r in S.decode(rows, known).collect()]
    assert got[:3] == ["!", "", None]


@pytest.mark.parametrize("lines", ["IQ== 0\n", "IQ== 0\nIg== 2\n"])
def test_broken_files_are_refused(spark, tmp_path, lines):
    path = tmp_path / "ranks"
    path.write_text(lines)
    with pytest.raises(ValueError):
        S.Subwords(spark, str(path))
