import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sftprep.operators.batches import shard, shuffle_rank, steps
from sftprep.session import hadoop_path
from sftprep.sources.shards import MANIFEST, open_shards, shard_index, write_shards


@pytest.fixture(scope="module")
def placed(spark):
    ids = spark.range(1000).select(F.col("id").alias("rec_id"))
    return shard(steps(shuffle_rank(ids, "rec_id", 3), 2, 2, 4), 4)


@pytest.fixture(scope="module")
def stored(placed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "shards")
    write_shards(placed, path, 7)
    return path


@pytest.mark.parametrize("first, last, worker", [(0, None, None), (20, None, 2), (20, 27, 1), (13, 14, None), (500, None, 0)])
def test_any_steps_open_like_a_filter(spark, placed, stored, first, last, worker):
    got = open_shards(spark, stored, first, last, worker)
    expected = placed.where(F.col("step").between(first, 10**9 if last is None else last))
    if worker is not None:
        expected = expected.where(F.col("worker") == worker)
    expected = expected.select(*got.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()
    assert len(got.inputFiles()) == shard_index(spark, stored).count()  # all files, before pruning


def test_files_of_other_steps_are_not_read(spark, stored):
    df = open_shards(spark, stored, 20, 27, 1)
    plan = plan_of(df)
    for part in ("PartitionFilters", "stretch", "PushedFilters: [IsNotNull(step), GreaterThanOrEqual(step,20)"):
        assert part in plan
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = scans.apply(0).metrics()
    # Steps 20 to 27 of one worker lie in stretches 2 and 3 of seven steps each.
    assert metrics.apply("numFiles").value() == 2 and metrics.apply("numPartitions").value() == 2
    index = shard_index(spark, stored).where("worker = 1 and stretch in (2, 3)")
    assert index.agg(F.count("*"), F.countDistinct("stretch")).first()[:] == (2, 2)


def test_files_are_ordered_and_indexed(spark, placed, stored):
    index = shard_index(spark, stored).collect()
    assert sum(r["n_rows"] for r in index) == 1000
    assert all(r["last_step"] - r["first_step"] < 7 for r in index)
    before = {}
    for r in sorted(index, key=lambda r: (r["worker"], r["stretch"])):
        assert r["rows_before"] == before.get(r["worker"], 0)
        before[r["worker"]] = r["rows_before"] + r["n_rows"]
    one = spark.read.parquet(f"{stored}/rows/worker=1/stretch=2")
    got = [tuple(r) for r in one.select("step", "batch_id").collect()]
    assert got == sorted(got)


def test_unfinished_and_empty_runs(spark, placed, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(ValueError):
        open_shards(spark, path)
    write_shards(placed.limit(0), path)
    assert open_shards(spark, path).count() == 0 and shard_index(spark, path).count() == 0
    files, named = hadoop_path(spark, f"{path}/{MANIFEST}")
    files.delete(named, False)
    with pytest.raises(ValueError):
        open_shards(spark, path)
    with pytest.raises(ValueError):
        write_shards(placed, str(tmp_path / "zero"), 0)
    with pytest.raises(ValueError):
        write_shards(placed.withColumn("stretch", F.lit(1)), str(tmp_path / "clash"))


def test_rows_without_a_place_are_refused(spark, placed, tmp_path):
    with pytest.raises(Exception, match="without step or worker"):
        write_shards(placed.withColumn("step", F.lit(None).cast("long")), str(tmp_path / "bad"))


def test_repeated_rows_and_other_columns_are_kept(spark, placed, tmp_path):
    path = str(tmp_path / "twice")
    twice = placed.union(placed).withColumn("file", F.lit("x"))
    write_shards(twice, path, 16)
    got = open_shards(spark, path)
    assert got.count() == 2000 and set(got.columns) == set(twice.columns)
