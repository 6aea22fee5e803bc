import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sftprep.functions import pieces
from sftprep.operators import tokens as K
from sftprep.operators.prompts import format_block


def test_pieces_by_hand(spark):
    df = spark.createDataFrame([("USER:　肺がん 😀",), ("",), (None,)], "text string")
    got = [r[0] for r in df.select(pieces("text")).collect()]
    assert got == [["USER", ":", "　", "肺", "が", "ん", " ", "😀"], [], []]


def test_pieces_lose_nothing(documents, edge_rows):
    for df in (documents, format_block(edge_rows).select("text")):
        assert df.where(F.array_join(pieces("text"), "") != F.col("text")).count() == 0


def test_vocab_order(documents, vocab):
    counted = Counter()
    for row in documents.select(pieces("text").alias("p")).collect():
        counted.update(row["p"])
    want = sorted(counted, key=lambda p: (-counted[p], p.encode()))[:500]
    got = [r["piece"] for r in vocab.table.orderBy("token_id").collect()]
    assert got[:3] == ["<unk>", "<s>", "</s>"] and got[3] == "<0x00>" and got[258] == "<0xFF>"
    assert got[259:759] == want
    letters = {c for p in counted for c in p} - set(want)
    assert got[759:] == sorted(letters) and vocab.size == len(got)


def test_hot_piece_is_counted_before_the_shuffle(spark):
    texts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 50))
        .otherwise(F.concat(F.lit("w"), "id"))
        .alias("text")
    )
    top = K.piece_counts(texts).orderBy(F.desc("n"), "piece").first()
    assert (top["piece"], top["n"]) == (" hot", 49 * 1000)
    assert "partial_count" in plan_of(K.piece_counts(texts))


@pytest.mark.parametrize("max_length", [None, 512, 7])
def test_encode_by_lookup_and_by_join_agree(documents, edge_rows, vocab, max_length):
    docs = documents.unionByName(
        format_block(edge_rows).select((-F.col("rec_id")).alias("doc_id"), "text")
    ).unionByName(documents.limit(1).select(F.lit(-99).cast("long").alias("doc_id"), F.lit("").alias("text")))
    a = K.tokenize(docs, vocab, max_length, key="doc_id")
    b = K.tokenize(docs, vocab, max_length, key="doc_id", via="join")
    columns = ["doc_id", "input_ids", "attention_mask", "length"]
    left = {r[0]: r for r in a.select(columns).collect()}
    right = {r[0]: r for r in b.select(columns).collect()}
    assert left == right and len(left) == docs.count()
    for r in left.values():
        assert r.input_ids[0] == K.BOS_ID and r.input_ids[-1] == K.EOS_ID
        assert r.length == len(r.input_ids) == sum(r.attention_mask)
        assert max_length is None or r.length <= max_length
    assert left[-99].input_ids == [K.BOS_ID, K.EOS_ID]


def test_lookup_moves_no_rows(documents, vocab):
    plan = plan_of(K.tokenize(documents, vocab))
    assert "ArrowEvalPython" in plan and "Exchange" not in plan


def test_hot_unknown_pieces_are_spelled(spark):
    """Characters and emoji no corpus had come back too, by either path."""
    small = K.build_vocab(spark.createDataFrame([("ab cd ab",)], "text string"), 2)
    rows = [(1, "ab abcd xyz"), (2, "肺がん 😀\u0000"), (None, "new"), (None, "new"), (5, ""), (6, None), (7, "<0x41> <unk>")]
    df = spark.createDataFrame(rows, "id int, text string")
    for via in ("auto", "join"):
        ids = K.encode(df, small, via=via)
        back = K.decode(ids, small, via=via)
        got = sorted((str(r["id"]), r["text"] or "", r["decoded"]) for r in back.collect())
        assert got == sorted((str(i), t or "", t or "") for i, t in rows)
        assert ids.where(F.array_contains("input_ids", K.UNK_ID)).count() == 0


def test_broken_bytes_read_as_replacement(spark, vocab):
    df = spark.createDataFrame([([1, 3 + 0xC3, 3 + 0x41, 2],)], "input_ids array<int>")
    got = [K.decode(df, vocab, via=via).first()["decoded"] for via in ("auto", "join")]
    assert got == ["\ufffdA", "\ufffdA"]


def test_a_vocabulary_over_the_limit_is_joined(documents, vocab, monkeypatch):
    monkeypatch.setattr("sftprep.session.MAX_SHIPPED_ROWS", 10)
    large = K.Vocabulary(vocab.table)
    assert large.shipped is None
    got = K.tokenize(documents, large).select("doc_id", "input_ids")
    want = K.tokenize(documents, vocab).select("doc_id", "input_ids")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    text = K.decode(K.tokenize(documents, large), large)
    same = K.decode(K.tokenize(documents, vocab), vocab).select("doc_id", "decoded")
    assert text.select("doc_id", "decoded").exceptAll(same).count() == 0


def test_round_trip_without_unknowns(documents):
    everything = K.build_vocab(documents, 100_000)
    ids = K.tokenize(documents, everything, None)
    assert ids.where(F.array_contains("input_ids", 0)).count() == 0
    assert K.decode(ids, everything).where("decoded <> text").count() == 0
    spelled = K.decode(ids, everything, skip_special=False).first()
    assert spelled["decoded"] == f"<s>{spelled['text']}</s>"


def test_padding_and_labels(spark):
    df = spark.createDataFrame(
        [(1, 0, [1, 0, 5, 2]), (2, 0, [1, 2]), (3, 1, [1, 7, 2])],
        "id int, batch_id int, input_ids array<int>",
    )
    got = {r["id"]: r for r in K.causal_labels(K.pad_batch(df)).collect()}
    assert got[2]["input_ids"] == [1, 2, 0, 0] and got[2]["attention_mask"] == [1, 1, 0, 0]
    assert got[3]["input_ids"] == [1, 7, 2]
    # A genuine unknown token is masked in the labels but not in the attention mask.
    assert got[1]["labels"] == [1, -100, 5, 2] and got[1]["attention_mask"] == [1, 1, 1, 1]
    assert got[2]["labels"] == [1, 2, -100, -100]
    eos = {r["id"]: r for r in K.causal_labels(K.pad_batch(df, pad_id=2), pad_id=2).collect()}
    assert eos[2]["input_ids"] == [1, 2, 2, 2] and eos[2]["labels"] == [1, -100, -100, -100]


def test_full_length_filter(documents, vocab):
    df = K.tokenize(documents, vocab, 64)
    kept = K.only_full_length(df, 64)
    assert 0 < kept.count() == df.where(F.size("input_ids") == 64).count() < df.count()


def test_pattern_agrees_with_a_plain_reading(documents):
    text = documents.orderBy(F.desc(F.length("text"))).first()["text"]
    got = documents.sparkSession.createDataFrame([(text,)], "text string").select(pieces("text"))
    plain = re.findall(r"[ \t\r\n　]?(?:(?!_)\w)+|.", text, re.S)
    assert got.first()[0] == plain


def test_long_batches_are_worked_on_in_parts():
    lists = pa.array([[1, 2, 3], [], [4], None, [5, 6], [7] * 9, []], pa.list_(pa.int32()))
    for most in (1, 2, 3, 5, 100):
        for part in (lists, lists.slice(2), lists.slice(1, 4), lists.slice(0, 0)):
            sizes = []

            def work(own):
                sizes.append(len(own.flatten()))
                return own

            got = K.in_parts(part, work, pa.list_(pa.int32()), most)
            assert got.to_pylist() == part.to_pylist()
            assert all(n <= most or n in (2, 3, 9) for n in sizes)


def test_a_join_moves_the_pieces_of_a_block_once(spark, vocab, monkeypatch):
    """Tokens used to be joined one by one; a block's distinct ones are enough."""
    rows = spark.createDataFrame([(i % 3, "aa bb " * 40 + "zqx\u0000") for i in range(50)], "id int, text string")
    met = []
    joined = K.join_frequent

    def counted(tokens, *args, **kwargs):
        met.append(tokens.count())
        return joined(tokens, *args, **kwargs)

    monkeypatch.setattr(K, "join_frequent", counted)
    there = K.encode(rows.coalesce(1), vocab, via="join")
    back = K.decode(there, vocab, via="join").collect()
    assert len(back) == 50 and all(r["decoded"] == r["text"] for r in back)
    assert len(met) == 2 and max(met) < 50


@pytest.mark.parametrize("cap", [2, 3, 9, 512])
def test_first_pieces_are_those_of_the_whole_text(spark, cap):
    texts = [("x" * 5000 + " y z",), ("ab " * 900,), (". " * 40,), ("a   b   " * 3,), ("肺がん 😀" * 30,), ("",), (None,)]
    df = spark.createDataFrame(texts, "text string")
    first = K.with_first_pieces(df, cap - 2).select("pieces").collect()
    assert first == K.truncate(K.with_pieces(df), cap).select("pieces").collect()


def test_a_filter_looks_ids_up_once(documents, vocab):
    plan = plan_of(K.only_full_length(K.tokenize(documents.repartition(4), vocab, 64), 64))
    assert plan.count("ArrowEvalPython") == 1


def test_arrow_batches_of_texts_are_small(spark, documents, vocab):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in (("10000", "512"), ("0", "512"), ("100", "100")):
            spark.conf.set(name, given)
            K.decode(K.encode(documents, vocab), vocab)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)


def test_texts_cut_outside_the_pattern_give_its_pieces(spark):
    """Every code point, alone and beside letters and spaces, and odd texts."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    draw = random.Random(5)
    some = ["a", "b", " ", "\t", "\n", "\u3000", "é", "e\u0301", "ж", "７", "肺", "😀", "\0", "_", *draw.sample(points, 200)]
    texts = [None, "", " ", "a", None, "".join(points), "".join(f"{c}a {c}" for c in points[:0x3000])]
    texts += ["".join(draw.choices(some, k=draw.randrange(40))) for _ in range(2000)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    kinds = K.character_kinds(spark).value
    kept = df.select(pieces("text").alias("p"), F.coalesce("text", F.lit("")).alias("text")).toArrow().combine_chunks()
    whole = kept.column("text").combine_chunks()
    # A slice starts inside its buffers.
    for part, want in ((whole, kept), (whole.slice(3, 50), kept.slice(3, 50)), (whole.slice(0, 0), kept.slice(0, 0))):
        flat, starts = K.cut(part, kinds)
        got = [flat.slice(a, b - a).to_pylist() for a, b in zip(starts, starts[1:])]
        assert got == want.column("p").to_pylist()
    want = df.select(F.explode(pieces("text")).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
    got = K.piece_counts_by_batch(df)
    assert got.dtypes == want.dtypes and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    small = K.build_vocab(df.where("length(text) < 100"), 40)
    ids = K.encode(df, small)
    want = K.encode(K.with_pieces(df), small)
    assert ids.exceptAll(want).count() == want.exceptAll(ids).count() == 0


def test_whole_texts_make_no_row_or_element_per_piece_in_spark(spark, documents, vocab):
    ids, counts = plan_of(K.tokenize(documents, vocab, None)), plan_of(K.piece_counts_by_batch(documents))
    assert "regexp_extract_all" not in ids + counts and "Generate" not in counts
    # What leaves Python is counted: one row per distinct piece of a part of a batch.
    once = spark.range(512).select(F.lit("one two " * 1000).alias("text")).coalesce(1)
    rows = K.piece_counts_by_batch(once).collect()
    assert sorted((r["piece"], r["n"]) for r in rows) == [(" ", 512), (" one", 511_488), (" two", 512_000), ("one", 512)]


def test_invalid_bytes_read_as_the_replacement_character(spark, vocab):
    df = spark.range(1).select(F.unhex(F.lit("61FF62E38120")).cast("string").alias("text"))
    assert K.encode(df, vocab).first() == K.encode(K.with_pieces(df), vocab).first()
    want = df.select(F.explode(pieces("text")).alias("piece")).collect()
    assert sorted(r["piece"] for r in K.piece_counts_by_batch(df).collect()) == sorted({r["piece"] for r in want})
