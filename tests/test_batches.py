import math

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sftprep.operators import batches as B
from sftprep.plans import flows


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows come from one source and share one text length."""
    i = F.col("id")
    return spark.range(1003).select(
        "id",
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), i)).alias("source"),
        F.when(i % 3 == 0, 40).otherwise(i % 97 + 3).cast("int").alias("length"),
    )


def ranks(df):
    return {r["id"]: r["rank"] for r in df.select("id", "rank").collect()}


def test_rank_is_a_repeatable_permutation(rows, spark):
    a = ranks(B.shuffle_rank(rows, "id", 45))
    assert sorted(a.values()) == list(range(1, 1004))
    assert a == ranks(B.shuffle_rank(rows.repartition(13), "id", 45))
    assert a == ranks(B.shuffle_rank(rows, "id", 45, digits=2))
    assert a != ranks(B.shuffle_rank(rows, "id", 46))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert a == ranks(B.shuffle_rank(rows, "id", 45))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("share,seed", [(0.1, 45), (0.2, 68), (0.0, 1), (1.0, 1), (0.0005, 7)])
def test_split_is_exact_and_follows_the_rank(rows, share, seed):
    split = B.train_test_split(rows, "id", share, seed)
    test = {r["id"] for r in split.where("split = 'test'").collect()}
    assert split.count() == 1003 and len(test) == B.held_out_rows(1003, share)
    order = ranks(B.shuffle_rank(rows, "id", seed))
    assert test == {i for i, r in order.items() if r <= math.ceil(share * 1003)}


@pytest.mark.parametrize("size,count", [(200, 6), (1003, 1), (334, 3), (1, 40), (700, 5)])
def test_intervals_follow_the_rank(rows, size, count):
    got = B.shuffle_rank(B.order_intervals(rows, "id", 45, size, count), "id", 45).collect()
    assert len(got) == 1003
    assert all(r["interval"] == min((r["rank"] - 1) // size, count - 1) for r in got)


def test_split_of_nothing(rows):
    assert B.train_test_split(rows.where("id < 0"), "id", 0.1, 45).count() == 0


def test_split_shuffles_no_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_of(B.train_test_split(docs, "doc_id", 0.1, 45))
    main = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]
    assert not any("Exchange" in line for line in main)
    # What is shuffled to find the last test row is ids only.
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    narrow = [s for s in scans if "ReadSchema: struct<doc_id:bigint>" in s]
    assert len(narrow) == len(scans) - 1


def test_epochs_differ(rows):
    got = B.epochs(rows.select("id"), "id", 3, 45)
    assert got.count() == 3 * 1003
    by_epoch = [ranks(got.where(F.col("epoch") == e)) for e in range(3)]
    assert all(sorted(r.values()) == list(range(1, 1004)) for r in by_epoch)
    assert by_epoch[0] != by_epoch[1] != by_epoch[2]


def test_length_batches(rows):
    ranked = B.shuffle_rank(rows, "id", 45)
    got = B.length_batches(ranked, "id", 4, 50).collect()
    batches = {}
    for r in got:
        batches.setdefault(r["batch_id"], []).append(r)
    assert sorted(batches) == list(range(math.ceil(1003 / 4)))
    for b, members in batches.items():
        assert len(members) == (4 if b < 250 else 3)
        assert sorted(m["slot"] for m in members) == list(range(len(members)))
        assert {m["width"] for m in members} == {max(m["length"] for m in members)}
        assert len({(m["rank"] - 1) // 200 for m in members}) == 1
    plain = B.rank_batches(ranked, 4).agg(F.sum("width")).first()[0]
    assert sum(r["width"] for r in got) < 0.8 * plain


def test_small_tables_take_smaller_mega_batches():
    assert [B.mega_factor(n, 4) for n in (1, 16, 160, 800, 10**9)] == [1, 1, 10, 50, 50]


def test_steps_and_shards(rows):
    ranked = B.shuffle_rank(rows, "id", 45)
    got = B.shard(B.steps(ranked, batch=4, accum=4, world=4, max_steps=10), 4).collect()
    assert len(got) == 10 * 64
    for r in got:
        assert r["batch_id"] == (r["rank"] - 1) // 4
        assert r["step"] == (r["rank"] - 1) // 64
        assert r["worker"] == r["batch_id"] % 4


def test_run_plan(rows):
    one = B.run_plan(rows, 4, 4, 1, 2, 0.1, 1000).first()
    assert (one.n_rows, one.test_rows, one.train_rows) == (1003, 101, 902)
    assert (one.batches_per_epoch, one.steps_per_epoch, one.epoch_steps) == (226, 57, 114)
    assert (one.total_steps, one.epochs_read) == (1000, 18)
    many = B.run_plan(rows, 1, 1, 4, 2, 0.2).first()
    assert (many.total_steps, many.epochs_read) == (402, 2)


def test_peek_is_a_top_n(rows):
    ranked = B.shuffle_rank(rows, "id", 45)
    assert B.peek(ranked).first()["rank"] == 1
    assert "TakeOrderedAndProject" in plan_of(B.peek(ranked, 2))


@pytest.mark.parametrize("config", [flows.FULL_RUN, flows.PARALLEL_ADAPTER_RUN, flows.RunConfig(max_steps=3)])
def test_training_plan_places_every_row_once_an_epoch(rows, config):
    plan = flows.training_plan(rows, "id", config)
    got = plan.collect()
    if B.step_cap(config.max_steps) is None:
        assert len(got) == 2 * 1003
    else:
        assert len(got) == config.max_steps * config.batch * config.accum * config.world
    assert len({(r["epoch"], r["id"]) for r in got}) == len(got)
    assert len({(r["epoch"], r["batch_id"], r["slot"]) for r in got}) == len(got)
    steps = {}
    for r in got:
        steps.setdefault(r["step"], set()).add((r["epoch"], r["batch_id"]))
    assert sorted(steps) == list(range(len(steps)))
    assert max(map(len, steps.values())) <= config.accum * config.world


@pytest.mark.parametrize("by_length", [True, False])
@pytest.mark.parametrize("max_steps", [1, 7, 40, 63])
def test_a_capped_plan_is_the_start_of_the_whole_plan(rows, by_length, max_steps):
    whole = flows.RunConfig(n_epochs=1, by_length=by_length)
    capped = flows.RunConfig(max_steps=max_steps, by_length=by_length)
    want = flows.training_plan(rows, "id", whole).where(F.col("step") < max_steps)
    got = flows.training_plan(rows, "id", capped)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_first_rows(rows):
    order = ranks(B.shuffle_rank(rows, "id", 45))
    for n in (1, 500, 1003, 5000):
        got = {r["id"] for r in B.first_rows(rows, "id", 45, n).collect()}
        assert got == {i for i, r in order.items() if r <= n}


def test_planning_reads_ids_and_lengths_only(spark, rows, tmp_path):
    wide = rows.withColumn("input_ids", F.array_repeat(F.lit(5), F.col("length")))
    wide.write.parquet(str(tmp_path / "rows"))
    saved = spark.read.parquet(str(tmp_path / "rows"))
    plan = plan_of(flows.training_plan(saved, "id", flows.PARALLEL_ADAPTER_RUN))
    assert "input_ids" not in plan
    # Windows over rows are partitioned; only the bucket table meets in one place.
    shards = flows.training_shards(saved, "id", flows.PARALLEL_ADAPTER_RUN)
    bad = shards.where("size(input_ids) <> width or size(labels) <> width")
    assert bad.count() == 0 and shards.count() == 2 * 1003


@pytest.mark.parametrize("cap", [-1, 0, None])
def test_no_cap(rows, cap):
    config = flows.RunConfig(max_steps=cap)
    plan = flows.training_plan(rows, "id", config)
    assert plan.count() == 2 * 1003 and plan.agg(F.min("epoch")).first()[0] == 0
    one = B.run_plan(rows, 4, 4, 1, 2, 0.1, cap).first()
    assert (one.total_steps, one.epochs_read) == (114, 2)
    ranked = B.shuffle_rank(rows, "id", 45)
    assert B.steps(ranked, 4, max_steps=cap).count() == 1003


def test_epochs_below_one_are_refused(rows):
    with pytest.raises(ValueError):
        B.epochs(rows, "id", 0, 45)
    with pytest.raises(ValueError):
        B.run_plan(rows, n_epochs=0)


def test_null_and_repeated_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, 5), (3, 6)], "id int, length int")
    assert sorted(r["rank"] for r in B.shuffle_rank(df, "id", 45).collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        flows.training_plan(df, "id", flows.FULL_RUN)


@pytest.mark.parametrize("n,world", [(903, 4), (5, 4), (1, 4), (8, 4), (1, 3)])
def test_even_workers(spark, n, world):
    df = spark.range(n).withColumn("batch_id", F.expr("id div 2")).withColumn("epoch", F.lit(0))
    for group in (None, ["epoch"]):
        got = B.shard(df, world, even=True, group=group)
        each = {r["worker"]: r["n"] for r in got.groupBy("worker").agg(F.count_distinct("batch_id").alias("n")).collect()}
        assert len(each) == world and len(set(each.values())) == 1
        assert got.select("id").distinct().count() == n


def test_padding_comes_after_the_last_shuffle(spark, rows, tmp_path):
    wide = rows.withColumn("input_ids", F.array_repeat(F.lit(5), F.col("length")))
    wide.write.parquet(str(tmp_path / "rows"))
    saved = spark.read.parquet(str(tmp_path / "rows"))
    placed = flows.placed_rows(saved, "id", flows.PARALLEL_ADAPTER_RUN)
    assert "array_repeat" not in plan_of(placed)
    flows.export_run(saved, "id", flows.PARALLEL_ADAPTER_RUN, str(tmp_path / "shards"))
    got = spark.read.parquet(str(tmp_path / "shards"))
    assert got.count() == 2 * 1003 and got.where("size(labels) <> width").count() == 0
