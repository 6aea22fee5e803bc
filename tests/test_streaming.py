import os

import pytest

from sftprep.operators.prompts import format_block
from sftprep.operators.tokens import causal_labels, tokenize
from sftprep.session import hadoop_path, new_path, passing
from sftprep.streaming.rows import prepare_rows, read_batches, read_rows, write_batches, write_rows


def test_arriving_rows_are_prepared_like_stored_ones(spark, edge_rows, vocab, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    edge_rows.write.parquet(source)
    arriving = read_rows(spark, source, edge_rows.schema)
    assert arriving.isStreaming
    for expected in (9, 18):
        write_rows(prepare_rows(arriving, vocab), sink, progress).awaitTermination(120)
        got = spark.read.parquet(sink)
        assert got.count() == expected
        edge_rows.write.mode("append").parquet(source)
    stored = causal_labels(tokenize(format_block(edge_rows), vocab))
    assert got.distinct().exceptAll(stored.select(got.columns)).count() == 0


def test_a_second_call_goes_on_where_the_first_ended(spark, edge_rows, vocab, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    arriving = None
    for expected in (9, 18):
        edge_rows.write.mode("append").parquet(source)
        arriving = arriving or read_rows(spark, source, edge_rows.schema)
        write_rows(prepare_rows(arriving, vocab), sink).awaitTermination(120)
        assert spark.read.parquet(sink).count() == expected


def test_a_joined_vocabulary_works_batch_by_batch(spark, edge_rows, vocab, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    edge_rows.write.parquet(source)
    arriving = read_rows(spark, source, edge_rows.schema)
    with pytest.raises(ValueError):
        prepare_rows(arriving, vocab, via="join")
    for expected in (9, 18):
        write_batches(arriving, sink, lambda rows: prepare_rows(rows, vocab, via="join")).awaitTermination(300)
        stored = causal_labels(tokenize(format_block(edge_rows), vocab))
        got = read_batches(spark, sink, stored.schema)
        assert got.count() == expected
        edge_rows.write.mode("append").parquet(source)
    assert got.distinct().exceptAll(stored.select(got.columns)).count() == 0
    assert stored.exceptAll(got.select(stored.columns)).count() == 0


def test_a_batch_that_runs_again_writes_nothing_twice(spark, edge_rows, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    edge_rows.write.parquet(source)
    arriving = read_rows(spark, source, edge_rows.schema)
    calls = []

    def prepare(rows):
        calls.append(rows.count())
        return rows.select("rec_id")

    write_batches(arriving, sink, prepare, progress).awaitTermination(120)
    # The rows are there but the commit is not: what a driver lost in between leaves.
    for name in os.listdir(f"{progress}/commits"):
        os.remove(f"{progress}/commits/{name}")
    write_batches(arriving, sink, prepare, progress).awaitTermination(120)
    assert calls == [9, 9] and read_batches(spark, sink, "rec_id long").count() == 9


def test_tables_of_a_batch_are_deleted_after_it(spark, edge_rows):
    kept = new_path(spark, "kept")
    edge_rows.write.parquet(kept)
    with passing(spark):
        passed = new_path(spark, "passed")
        edge_rows.write.parquet(passed)
    there = {}
    for path in (kept, passed):
        files, named = hadoop_path(spark, path)
        there[path] = files.exists(named)
    assert there == {kept: True, passed: False}
