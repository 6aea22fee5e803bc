import math
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sftprep.operators import lm as L
from sftprep.operators import replay as R
from sftprep.plans import flows

TRAIN = [(1, 0, [1, 3, 4, 3, 2]), (2, 1, [1, 3, 0, 4, 2]), (3, 2, [1, 4, 4, 4, 2]), (4, 5, [1, 2])]
TEST = [(9, 0, [1, 3, 4, 2]), (10, 0, [1, 5, 0, 2])]
SCHEMA = "id int, step int, input_ids array<int>"


def pairs(rows):
    return Counter((a, b) for r in rows for a, b in zip(r[2], r[2][1:]) if b != 0)


def loss(train, test, share=0.7):
    model = pairs(train)
    context, alone = Counter(), Counter()
    for (a, b), n in model.items():
        context[a] += n
        alone[b] += n
    total = sum(model.values())
    logs = weight = 0
    for (a, b), w in pairs(test).items():
        pair = model[a, b] / context[a] if context[a] else 0.0
        p = share * pair + (1 - share) * (alone[b] + 1) / (total + len(alone) + 1)
        logs -= w * math.log(p)
        weight += w
    return logs / weight, weight


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame(TEST, SCHEMA)


def test_counts(train):
    got = {(r.prev, r.next): r.n for r in L.fit_lm(train).collect()}
    assert got == dict(pairs(TRAIN))


def test_loss_against_brute_force(train, test):
    got = L.eval_loss(L.fit_lm(train), test).first()
    want, weight = loss(TRAIN, TEST)
    assert got.eval_loss == pytest.approx(want, abs=1e-12) and got.eval_tokens == weight


def test_checkpoints_hold_all_steps_before_them(train, test):
    at = F.expr("cast(step div 2 as int)")
    fresh = L.checkpoint_counts(train, at)
    states = L.checkpoints(fresh, 3).collect()
    losses = {r.checkpoint: r.eval_loss for r in L.checkpoint_losses(fresh, 3, test).collect()}
    for c in (1, 2, 3):
        rows = [r for r in TRAIN if r[1] < 2 * c]
        got = {(r.prev, r.next): r.n for r in states if r.checkpoint == c}
        assert got == dict(pairs(rows))
        assert losses[c] == pytest.approx(loss(rows, TEST)[0], abs=1e-12)


def test_an_empty_first_state_is_uniform_not_an_error(spark, test):
    late = spark.createDataFrame([(1, 7, [1, 3, 2])], SCHEMA)
    got = {r.checkpoint: r.eval_loss for r in L.checkpoint_losses(
        L.checkpoint_counts(late, F.expr("cast(step div 5 as int)")), 2, test).collect()}
    assert got[1] == pytest.approx(-math.log(0.3)) and got[2] < 10


def test_adapted_contexts_sum_to_one(spark, train, test):
    mixed = L.adapt(L.fit_lm(train), L.fit_lm(test), 0.25)
    sums = mixed.groupBy("prev").agg(F.sum("p").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)
    p = {(r.prev, r.next): r.p for r in mixed.collect()}
    base, domain = pairs(TRAIN), pairs(TEST)
    in_base = sum(n for (a, _), n in base.items() if a == 1)
    in_domain = sum(n for (a, _), n in domain.items() if a == 1)
    assert p[1, 3] == pytest.approx(0.25 * domain[1, 3] / in_domain + 0.75 * base[1, 3] / in_base)
    assert p[1, 5] == pytest.approx(0.25 * domain[1, 5] / in_domain)


def test_best_checkpoint_takes_the_earliest_of_equals(spark):
    losses = spark.createDataFrame([(3, 1.5), (2, 1.5), (1, 2.0)], "checkpoint int, eval_loss double")
    assert tuple(L.best_checkpoint(losses).first()) == (2, 1.5)


def test_metrics_accumulate(train, test):
    rows = train.select(
        "input_ids",
        "step",
        F.expr("cast(step div 2 as int)").alias("interval"),
        F.size("input_ids").alias("length"),
    )
    losses = L.checkpoint_losses(L.checkpoint_counts(rows), 3, test)
    out = L.metrics(rows, losses).orderBy("checkpoint")
    got = [tuple(r) for r in out.select("checkpoint", "step", "rows_seen", "tokens_seen").collect()]
    assert got == [(1, 2, 2, 10), (2, 3, 3, 15), (3, 6, 4, 17)]


def test_many_checkpoints(spark, test):
    """More than a hundred states, each the sum of all rows before it."""
    rows = [(i, i, [1, 3 + i % 7, 2]) for i in range(150)]
    train = spark.createDataFrame(rows, SCHEMA)
    fresh = L.checkpoint_counts(train, "step")
    got = {r["checkpoint"]: r["n"] for r in L.checkpoints(fresh, 150).groupBy("checkpoint").agg(F.sum("n").alias("n")).collect()}
    assert got == {c: 2 * c for c in range(1, 151)}
    losses = {r.checkpoint: r.eval_loss for r in L.checkpoint_losses(fresh, 150, test).collect()}
    assert len(losses) == 150
    assert losses[120] == pytest.approx(loss([r for r in rows if r[1] < 120], TEST)[0], abs=1e-12)


def many_rows(spark, n=240):
    rows = [(i, i // 4, [1, 3 + i % 7, 3 + i % 5, 0, 4 + i % 3, 2][: 2 + i % 5]) for i in range(n) if i // 4 % 9]
    return rows, spark.createDataFrame(rows, SCHEMA).withColumn("interval", F.col("step"))


def test_sums_of_states_without_states(spark):
    rows, train = many_rows(spark)
    fresh = L.checkpoint_counts(train, by_interval=True)
    weight = F.col("prev") * 7 + F.col("next")
    got = {r[0]: tuple(r)[1:] for r in L.checkpoint_sums(fresh, 50, check=weight).collect()}
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, L.checkpoint_counts(train).collect()))
    for c in range(1, 51):
        state = pairs([r for r in rows if r[1] < c])
        want = (len(state), sum(state.values()), sum((7 * a + b) * n for (a, b), n in state.items()))
        assert got.get(c, (0, 0, 0)) == want
    # Rows read grow with pairs and intervals, not with states.
    assert "Generate explode" not in plan_of(L.checkpoint_sums(fresh, 50, check=weight))


@pytest.mark.parametrize("stretches", [1, 7, 64])
def test_a_run_read_again_equals_its_states(spark, test, monkeypatch, stretches):
    monkeypatch.setattr(R, "TOKENS", 20)
    monkeypatch.setattr(R, "STRETCHES", stretches)
    monkeypatch.setattr(R, "PAIRS", 3)
    rows, train = many_rows(spark)
    fresh = L.checkpoint_counts(train)
    held = test.union(train.drop("interval").limit(20))
    want = {r["checkpoint"]: r for r in L.checkpoint_losses(fresh, 55, held).collect()}
    got = {r["checkpoint"]: r for r in R.replayed_losses(train, 55, held).collect()}
    assert set(got) == set(want) == set(range(1, 56))
    log = {r["interval"]: r for r in L.run_log(fresh).where("interval < 55").collect()}
    again = {r["interval"]: r for r in R.replayed_log(train, 55).collect()}
    assert set(log) == set(again)
    for a, b in [*((want[c], got[c]) for c in want), *((log[i], again[i]) for i in log)]:
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-12)
    assert R.replayed_losses(train, 55, held.limit(0)).count() == 0


def test_a_run_is_read_again_without_a_row_for_each_token(spark):
    """Wide, negative and null ids; a null context is not the id 0."""
    some = [0, 5, 70_000, -3, 2_000_000_000, None]
    ids = [[some[(i * 7 + j * j + i // 5) % 6] for j in range(i % 6)] for i in range(300)]
    rows = spark.createDataFrame(
        [(i // 6, x) for i, x in enumerate([*ids, None])], "interval int, input_ids array<int>"
    )
    held = spark.createDataFrame([([None, 5],), ([0, 5],), ([5, 70_000, -3],), ([None, 0, None, 7],)], "input_ids array<int>")
    fresh = L.checkpoint_counts(rows)
    want = {r["checkpoint"]: tuple(r) for r in L.checkpoint_losses(fresh, 52, held).collect()}
    replayed = R.replayed_losses(rows, 52, held)
    got = {r["checkpoint"]: tuple(r) for r in replayed.collect()}
    assert set(got) == set(want) == set(range(1, 53))
    assert all(got[c] == pytest.approx(want[c], rel=1e-12) for c in want)
    assert "Generate inline" not in plan_of(replayed)
    pairs_of = R.run_pairs(R.counted_run(rows, 50)).collect()
    key = lambda r: (r["interval"], r["prev"] is None, r["prev"], r["next"], r["n"])
    assert sorted(map(key, pairs_of), key=str) == sorted(map(key, fresh.collect()), key=str)


def test_a_run_saved_where_it_is_evaluated_is_counted_once(spark, tmp_path, monkeypatch):
    rows = spark.range(640).select(
        F.col("id").alias("rec"), F.lit(4).alias("length"),
        F.array(F.lit(1), *[(F.col("id") * k % 11 + 3).cast("int") for k in (3, 7)], F.lit(2)).alias("input_ids"),
    )
    config = flows.RunConfig(by_length=False, n_epochs=1, save_steps=1, eval_steps=1)
    placed, count = flows.placed_states(rows, "rec", config)
    assert count == 40 >= R.MANY_INTERVALS
    counted = flows.run_counts(placed, count)
    assert "Generate inline" not in plan_of(counted)
    want = sorted(map(tuple, L.checkpoint_counts(placed).select("prev", "next", "interval", "n").collect()))
    assert sorted(map(tuple, counted.select("prev", "next", "interval", "n").collect())) == want
    passes = []
    monkeypatch.setattr(flows, "counted_run", lambda *a: passes.append(a) or R.counted_run(*a))
    found, model = flows.evaluate_run(rows, rows.where("rec < 90"), "rec", config, str(tmp_path / "log, 1"))
    assert len(passes) == 1 and found.count() == 40
    losses = L.checkpoint_losses(L.checkpoint_counts(placed), count, rows.where("rec < 90"))
    best = L.best_checkpoint(losses).first()["checkpoint"]
    got = {(r["prev"], r["next"]): r["n"] for r in model.collect()}
    state = Counter()
    for prev, following, interval, n in want:
        if interval < best:
            state[prev, following] += n
    assert got == dict(state)


def test_rows_seen_are_the_rows_of_the_plan(spark):
    rows = spark.range(300).select("id", F.lit(3).alias("length"), F.array(*map(F.lit, (1, 3, 2))).alias("input_ids"))
    for config in (flows.RunConfig(n_epochs=3, eval_steps=7), flows.RunConfig(max_steps=10, eval_steps=4),
                   flows.RunConfig(eval_steps=0)):
        placed, count = flows.placed_states(rows, "id", config)
        plan = flows.training_plan(rows, "id", config)
        every, _ = config.cadence(300, config.eval_steps)
        losses = L.checkpoint_losses(L.checkpoint_counts(placed), count, rows)
        got = L.metrics(placed, losses).collect()
        assert len(got) == count
        for r in got:
            assert r["rows_seen"] == plan.where(F.col("step") < r["checkpoint"] * every).count()


def test_run_log_scores_each_interval_by_what_came_before(train):
    at = F.expr("cast(step div 2 as int)")
    got = {r["interval"]: r for r in L.run_log(L.checkpoint_counts(train, at)).collect()}
    for interval in (0, 1, 2):
        before = pairs([r for r in TRAIN if r[1] // 2 < interval])
        context, alone = Counter(), Counter()
        for (v, w), n in before.items():
            context[v] += n
            alone[w] += n
        total, types = sum(alone.values()), len(alone)
        own = list(pairs([r for r in TRAIN if r[1] // 2 == interval]).elements())
        losses = [
            -math.log(0.7 * (before[v, w] / context[v] if context[v] else 0) + 0.3 * (alone[w] + 1) / (total + types + 1))
            for v, w in own
        ]
        assert got[interval]["tokens"] == len(own)
        assert math.isclose(got[interval]["loss"], sum(losses) / len(own), rel_tol=1e-9)


def test_runs_save_evaluate_and_log_at_their_own_cadence(spark, tmp_path):
    rows = spark.range(320).select(
        F.col("id").alias("rec"), F.array(F.lit(1), (F.col("id") % 7 + 3).cast("int"), F.lit(2)).alias("input_ids"),
        F.lit(3).alias("length"),
    )
    config = flows.RunConfig(by_length=False, n_epochs=1, save_steps=8, eval_steps=5, logging_steps=4)
    log = flows.save_run(rows, "rec", config, str(tmp_path / "log"))
    assert log.saved() == [1, 2, 3] and config.total_steps(320) == 20
    sizes = [log.state(c).agg(F.sum("n")).first()[0] for c in log.saved()]
    assert sizes == [2 * 16 * 8, 2 * 16 * 16, 2 * 320]
    steps = sorted(r["step"] for r in flows.logged_run(rows, "rec", config).collect())
    assert steps == [4, 8, 12, 16, 20]
    # Evaluated at 5, 10, 15 and 20, saved at 8, 16 and 20: only the last step was both.
    found, model = flows.evaluate_run(rows, rows, "rec", config, str(tmp_path / "log"))
    assert found.count() == 4 and model.agg(F.sum("n")).first()[0] == 640
    losses = spark.createDataFrame([(c, float(c)) for c in range(1, 5)], "checkpoint int, eval_loss double")
    assert flows.best_saved(losses, config, 320) == (3, 4)
    odd = flows.RunConfig(by_length=False, max_steps=6, save_steps=5, eval_steps=2)
    assert flows.best_saved(losses, odd, 320)[0] == 2


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_ngram_probabilities_sum_to_one(spark, train, order):
    model = L.fit_ngrams(train, order).cache()
    known = [r[0] for r in model.select("next").distinct().collect()]
    contexts = [c for c in ([], [1], [4], [3, 4], [9], [9, 3], [4, 4, 4], [8, 1, 3]) if len(c) < order]
    asked = [(c, w) for c in contexts for w in [*known, 999]]
    rows = spark.createDataFrame(asked, "context array<int>, next int")
    sums = Counter()
    for r in L.ngram_probs(model, rows).collect():
        assert r["p"] > 0
        sums[tuple(r["context"])] += r["p"]
    assert len(sums) == len(contexts) and all(math.isclose(s, 1.0) for s in sums.values())


def test_ngram_loss_of_long_contexts(spark, train, test):
    got = [L.ngram_loss(L.fit_ngrams(train, n), test, n).first() for n in (1, 3)]
    tokens = sum(pairs(TEST).values())
    assert got[0]["eval_tokens"] == got[1]["eval_tokens"] == tokens
    alone = Counter(b for (_, b), n in pairs(TRAIN).items() for _ in range(n))
    size = sum(alone.values()) + len(alone) + 1
    want = sum(-n * math.log((alone[b] + 1) / size) for (_, b), n in pairs(TEST).items()) / tokens
    assert math.isclose(got[0]["eval_loss"], want, rel_tol=1e-9)
    empty = L.fit_ngrams(train.limit(0), 3)
    assert empty.collect() == [] and L.ngram_loss(empty, test, 3).first()["eval_loss"] == 0.0


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_ngrams_are_counted_by_plain_columns(train, order):
    got = {(r["length"], tuple(r["context"]), r["next"]): r["n"] for r in L.fit_ngrams(train, order).collect()}
    want = Counter()
    for _, _, ids in TRAIN:
        for i in range(1, len(ids)):
            for length in range(min(i, order - 1) + 1):
                if ids[i] != 0:
                    want[length, tuple(ids[i - length : i]), ids[i]] += 1
    assert got == dict(want)
    # Grouping by arrays took most of the time.
    assert "keys=[context" not in plan_of(L.fit_ngrams(train, order)).replace("length#", "")
    assert order == 1 or "_back1" in plan_of(L.fit_ngrams(train, order))


@pytest.mark.parametrize("most", [1, 7, 1 << 22])
def test_ngrams_are_counted_where_the_rows_lie(spark, monkeypatch, most):
    """Parts of any size, ids that do not fit into one number together, and null ids."""
    monkeypatch.setattr(L, "NGRAM_TOKENS", most)
    some = [0, 5, 70_000, -3, 2_000_000_000, None]
    ids = [[some[(i * 7 + j * j + i // 5) % 6] for j in range(i % 7)] for i in range(60)]
    rows = spark.createDataFrame([(x,) for x in [*ids, None]], "input_ids array<int>").coalesce(2)
    model = L.fit_ngrams(rows, 4)
    plan = plan_of(model)
    got = {(r["length"], tuple(r["context"]), r["next"]): r["n"] for r in model.collect()}
    want = Counter()
    for row in ids:
        for i in range(1, len(row)):
            for length in range(min(i, 3) + 1):
                if row[i] not in (0, None):
                    want[length, tuple(row[i - length : i]), row[i]] += 1
    assert got == dict(want)
    # All lengths come from one pass, and no row is made of a token.
    assert "Generate" not in plan and plan.count("MapInArrow") == 1


def test_a_log_of_many_intervals_makes_no_row_of_a_token(spark):
    some = [0, 5, 70_000, -3, 2_000_000_000, None]
    ids = [[some[(i * 7 + j * j + i // 5) % 6] for j in range(i % 6)] for i in range(300)]
    rows = spark.createDataFrame([(i // 6, x) for i, x in enumerate(ids)], "interval int, input_ids array<int>")
    want = {r["interval"]: tuple(r) for r in L.run_log(L.checkpoint_counts(rows)).collect()}
    replayed = R.replayed_log(rows, 50)
    assert "Generate inline" not in plan_of(replayed)
    got = {r["interval"]: tuple(r) for r in replayed.collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], rel=1e-12) for i in want)


def test_metrics_of_many_checkpoints_make_no_row_of_a_token(spark):
    rows = spark.range(640).select(
        F.col("id").alias("rec"), F.lit(4).alias("length"),
        F.array(F.lit(1), *[(F.col("id") * k % 11 + 3).cast("int") for k in (3, 7)], F.lit(2)).alias("input_ids"),
    )
    placed, count = flows.placed_states(rows, "rec", flows.RunConfig(by_length=False, n_epochs=1, eval_steps=1))
    found = L.metrics(placed, flows.run_losses(placed, count, rows.where("rec < 90")))
    assert "Generate inline" not in plan_of(found)
    slow = L.metrics(placed, L.checkpoint_losses(L.checkpoint_counts(placed), count, rows.where("rec < 90")))
    got, want = (sorted(map(tuple, df.collect())) for df in (found, slow))
    assert len(got) == len(want) == 40
    assert all(a == pytest.approx(b, rel=1e-12) for a, b in zip(got, want))
