import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sftprep.operators.batches import shard, shuffle_rank, steps, train_test_split
from sftprep.operators.lm import checkpoint_sums
from sftprep.operators.prompts import format_block
from sftprep.sources import datasets as D
from sftprep.sources.models import StateLog, load_lm, save_lm, saved_counts

SCHEMA = "rec_id long, instruction string, input string, output string"


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_formats_round_trip(spark, edge_rows, tmp_path, fmt):
    path = str(tmp_path / fmt)
    rows = edge_rows.na.fill("") if fmt == "csv" else edge_rows
    writer = rows.write.format(fmt)
    if fmt == "csv":
        writer = writer.options(header="true", escape='"', quoteAll="true", emptyValue="")
    writer.save(path)
    got = D.load_split(spark, path, fmt=fmt, schema=SCHEMA)
    if fmt == "csv":
        got = got.na.fill("")
        same = [(r[0], (r[1] or "").strip()) for r in rows.select("rec_id", "instruction").collect()]
        back = [(r[0], (r[1] or "").strip()) for r in got.select("rec_id", "instruction").collect()]
        assert sorted(same) == sorted(back)
    else:
        assert got.exceptAll(edge_rows).count() == 0 and got.count() == 9


def test_unknown_inputs(spark, edge_rows, tmp_path):
    path = str(tmp_path / "rows")
    edge_rows.write.parquet(path)
    for wrong in ({"fmt": "orc"}, {"split": "test"}, {"fmt": "json"}):
        with pytest.raises(ValueError):
            D.load_split(spark, path, **wrong)


def test_saved_splits_are_pruned(spark, edge_rows, tmp_path):
    path = str(tmp_path / "prepared")
    rows = format_block(train_test_split(edge_rows, "rec_id", 0.3, 45))
    counted, seen = D.count_while_reading(rows)
    D.save_dataset(counted, path)
    assert seen.get == {"n_rows": 9}
    train, test = (D.load_split(spark, path, s) for s in ("train", "test"))
    assert (D.count_records(train).first()[0], D.count_records(test).first()[0]) == (6, 3)
    assert "PartitionFilters: [isnotnull(split" in plan_of(test)
    assert train.unionByName(test).exceptAll(rows.drop("split").select(train.columns)).count() == 0


def test_exported_shards_are_whole_and_in_order(spark, tmp_path):
    path = str(tmp_path / "shards")
    ranked = shuffle_rank(spark.range(500), "id", 45)
    placed = shard(steps(ranked, 4, 4, 4), 4).withColumn("slot", (F.col("rank") - 1) % 4)
    D.export_shards(placed, path)
    back = spark.read.schema(placed.schema).parquet(path).select(placed.columns)
    assert back.exceptAll(placed).count() == 0 and back.count() == 500
    files = back.select("*", F.input_file_name().alias("file"))
    assert files.select("file").distinct().count() >= 4
    # A batch never straddles two files.
    assert files.groupBy("worker", "batch_id").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0


def test_one_checkpoint_is_read(spark, tmp_path):
    states = spark.createDataFrame(
        [(1, 3, 4, 2), (2, 3, 4, 5), (2, 4, 3, 1)],
        "checkpoint int, prev int, next int, n long",
    )
    path = str(tmp_path / "model")
    save_lm(states, path)
    last = load_lm(spark, path, 2)
    assert sorted(map(tuple, last.collect())) == [(3, 4, 5), (4, 3, 1)]
    assert "PartitionFilters: [isnotnull(checkpoint" in plan_of(last)


def test_settled_tables_can_be_discarded(spark):
    import os

    from sftprep import session

    kept = list(session._HANDED_OUT)
    session._HANDED_OUT.clear()
    try:
        df = session.settle(spark.range(3))
        path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path) and session.discard_settled(spark) == 1 and not os.path.exists(path)
        assert session.discard_settled(spark) == 0
    finally:
        session._HANDED_OUT.extend(kept)


def kept(spark, tmp_path, **more):
    rows = spark.read.parquet(str(tmp_path / "in")).withColumn("split", F.lit("train"))
    return D.reuse(rows, str(tmp_path / "kept"), [str(tmp_path / "in")], **more)


def test_prepared_rows_are_reused_until_something_changes(spark, edge_rows, tmp_path):
    edge_rows.write.parquet(str(tmp_path / "in"))
    first, again = kept(spark, tmp_path), kept(spark, tmp_path)
    assert (first.hit, again.hit) == (False, True) and first.path == again.path
    assert again.rows.count() == 9 and again.rows.columns == [*edge_rows.columns, "split"]
    # The second call reads what was kept and no source file.
    assert all("/kept/" in f for f in again.rows.inputFiles())
    other = kept(spark, tmp_path, settings={"seed": 1})
    assert not other.hit and other.path != first.path and kept(spark, tmp_path, settings={"seed": 1}).hit
    edge_rows.limit(2).write.mode("append").parquet(str(tmp_path / "in"))
    grown = kept(spark, tmp_path)
    assert not grown.hit and grown.rows.count() == 11 and kept(spark, tmp_path).hit


def test_another_plan_is_another_entry(spark, edge_rows, tmp_path):
    edge_rows.write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in")).withColumn("split", F.lit("train"))
    root, sources = str(tmp_path / "kept"), [str(tmp_path / "in")]
    assert not D.reuse(rows, root, sources).hit
    assert not D.reuse(rows.where("rec_id > 3"), root, sources).hit
    assert D.reuse(spark.read.parquet(sources[0]).withColumn("split", F.lit("train")), root, sources).hit


def test_half_written_entries_are_not_read(spark, edge_rows, tmp_path):
    import os

    edge_rows.write.parquet(str(tmp_path / "in"))
    first = kept(spark, tmp_path)
    entry = os.path.dirname(first.path)
    os.remove(os.path.join(entry, D.MANIFEST))
    again = kept(spark, tmp_path)
    assert not again.hit and again.path != first.path and again.rows.count() == 9
    with open(os.path.join(entry, D.MANIFEST), "w") as file:
        file.write('{"data": "da')
    crc = os.path.join(entry, f".{D.MANIFEST}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert not kept(spark, tmp_path).hit and kept(spark, tmp_path).hit
    os.remove(os.path.join(kept(spark, tmp_path).path, "_SUCCESS"))
    assert not kept(spark, tmp_path).hit


def increments(spark):
    rows = [(1, 2, 0, 3), (1, 3, 0, 1), (1, 2, 2, 5), (4, 4, 2, 1), (1, 2, 3, 1)]
    return spark.createDataFrame(rows, "prev int, next int, interval int, n long")


def state(log, checkpoint):
    return sorted(tuple(r) for r in log.state(checkpoint).collect())


def test_states_are_sums_of_increments(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.saved() == [] and state(log, 0) == []
    assert log.append(increments(spark), [1, 2, 3, 4]) == [1, 2, 3, 4] and log.saved() == [1, 2, 3, 4]
    assert state(log, 1) == state(log, 2) == [(1, 2, 3), (1, 3, 1)]
    assert state(log, 4) == [(1, 2, 9), (1, 3, 1), (4, 4, 1)]
    # What is kept grows with new counts, not with states.
    assert spark.read.parquet(str(tmp_path / "log" / "increment" / "*")).count() == 5
    log.compact(3)
    assert state(log, 4) == [(1, 2, 9), (1, 3, 1), (4, 4, 1)] and state(log, 3)[0] == (1, 2, 8)
    assert {f.split("/")[-3] for f in log.state(4).inputFiles()} == {"full", "increment"}
    assert len({f.rsplit("/", 1)[0] for f in log.state(4).inputFiles()}) == 2


def test_all_states_from_one_reading(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.counts() == []
    log.append(increments(spark).union(increments(spark)), [1, 2, 3, 4])
    assert state(log, 1) == [(1, 2, 6), (1, 3, 2)]
    log.compact(3)
    found = [(first, last, checkpoint_sums(rows, last).where(F.col("checkpoint") >= first).collect()) for first, last, rows in log.counts()]
    assert [f[:2] for f in found] == [(1, 2), (3, 4)]
    assert sorted(tuple(r) for f in found for r in f[2]) == [(1, 2, 8), (2, 2, 8), (3, 3, 20), (4, 3, 22)]


def test_many_saves_are_one_pass(spark, tmp_path):
    """A job per save would read all counts for each of them."""
    rows = spark.range(400).selectExpr("cast(id % 5 as int) prev", "cast(id % 7 as int) next", "cast(id % 100 as int) interval", "id n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("saves", "saves")
    log = StateLog(spark, str(tmp_path / "log"))
    log.append(rows, list(range(1, 101)))
    jobs = len(tracker.getJobIdsForGroup("saves"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert log.saved() == list(range(1, 101)) and jobs < 10


def test_states_saved_as_increments(spark, tmp_path):
    path = str(tmp_path / "model")
    save_lm(increments(spark), path)
    assert sorted(map(tuple, load_lm(spark, path, 3).collect())) == [(1, 2, 8), (1, 3, 1), (4, 4, 1)]
    assert sorted(map(tuple, load_lm(spark, path, 2).collect())) == [(1, 2, 3), (1, 3, 1)]
    assert saved_counts(spark, path).count() == 5


def test_a_run_goes_on_where_it_was_cut_short(spark, tmp_path):
    import os

    log = StateLog(spark, str(tmp_path / "log"))
    log.append(increments(spark), [1, 2, 3])
    os.remove(str(tmp_path / "log" / "increment" / "00000002" / "_SUCCESS"))
    assert log.saved() == [1]
    with pytest.raises(ValueError):
        log.state(3)
    assert log.append(increments(spark), [1, 2, 3, 4]) == [2, 4]
    assert log.saved() == [1, 2, 3, 4] and state(log, 4)[0] == (1, 2, 9)
