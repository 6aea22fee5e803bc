import math
import os
from collections import Counter
from hashlib import md5

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sftprep.operators import lm as L
from sftprep.operators import predict as G
from sftprep.operators import tokens as K
from sftprep.session import settle
from sftprep.sources.models import share_table


@pytest.fixture(scope="module")
def model(documents, vocab):
    return settle(L.fit_lm(K.tokenize(documents, vocab, None)))


@pytest.fixture(scope="module")
def table(model):
    return settle(G.candidates(model))


@pytest.fixture(scope="module")
def prompts(spark, vocab):
    asked = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(
        F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt")
    )
    return K.encode(asked, vocab, text="prompt", add_eos=False)


def draw(counts, prev, t, u, top_p=0.7, top_k=50):
    """One draw, written out plainly."""
    row = [(n, b) for (a, b), n in counts.items() if a == prev]
    if not row:
        total = Counter()
        for (_, b), n in counts.items():
            total[b] += n
        row = [(n, b) for b, n in total.items()]
    row = sorted(row, key=lambda x: (-x[0], x[1]))[:top_k]
    w = [(n / row[0][0]) ** (1 / t) for n, _ in row]
    kept, before = [], 0.0
    for x, (_, b) in zip(w, row):
        if round(before / sum(w), 9) >= top_p:
            break
        kept.append((x, b))
        before += x
    so_far = 0.0
    for x, b in kept:
        so_far += x
        if round(so_far / before, 9) > u:
            return b
    return kept[-1][1]


def uniform(seed, key, step):
    return int(md5(f"{seed}:{key}:{step}".encode()).hexdigest()[:8], 16) / 2**32


def test_draws_against_brute_force(model, table, prompts):
    counts = {(r.prev, r.next): r.n for r in model.collect()}
    got = G.generate(prompts, table, "prompt_id", 3, 0.8, 12).collect()
    assert len(got) == prompts.count()
    for r in got:
        ids = list(r.input_ids)
        for step in range(12):
            ids.append(draw(counts, ids[-1], 0.8, uniform(3, r.prompt_id, step)))
            if ids[-1] == K.EOS_ID:
                break
        assert r.output_ids == ids


def test_generation_by_join_agrees(table, prompts):
    limit = F.col("prompt_id") % 13
    heat = 0.6 + (F.col("prompt_id") % 3) * 0.3
    a = G.generate(prompts, table, "prompt_id", 5, heat, limit)
    b = G.generate(prompts, table, "prompt_id", 5, heat, limit, via="join")
    columns = ["prompt_id", "output_ids"]
    assert a.select(columns).exceptAll(b.select(columns)).count() == 0
    assert b.count() == prompts.count()


def test_one_draw_agrees_whatever_the_join(table, prompts):
    ctx = prompts.select("prompt_id", F.element_at("input_ids", -1).alias("prev"))
    unseen = ctx.limit(3).withColumn("prev", F.lit(999_999))
    ctx = ctx.unionByName(unseen.withColumn("prompt_id", F.col("prompt_id") + 1000))
    a = G.sample_next(ctx, table, "prompt_id", 5, 0, 0.7)
    b = G.sample_next(ctx, table, "prompt_id", 5, 0, 0.7, via="join")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() == ctx.count()


def test_same_seed_same_text_other_seed_other_text(table, prompts):
    def run(seed):
        rows = G.generate(prompts, table, "prompt_id", seed, 1.0, 20).collect()
        return {r.prompt_id: r.output_ids for r in rows}

    assert run(1) == run(1) != run(2)


def test_nucleus_is_enough_and_minimal(model):
    probs = G.with_temperature(G.next_probs(model), 0.7)
    sums = probs.groupBy("prev").agg(F.sum("p").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    head = probs.join(G.nucleus(probs, 0.7, 10**6).select("prev", "next"), ["prev", "next"])
    mass = head.groupBy("prev").agg(F.sum("p").alias("m"), F.min("p").alias("last"))
    assert mass.where((F.col("m") < 0.7 - 1e-6) | (F.col("m") - F.col("last") > 0.7 + 1e-6)).count() == 0
    assert G.nucleus(probs, 1.0, 3).agg(F.max("rank")).first()[0] == 3


def test_extreme_temperatures(table, prompts):
    cold = G.generate(prompts, table, "prompt_id", 1, 0.01, 3)
    same = G.generate(prompts, table, "prompt_id", 2, 0.01, 3)
    assert cold.exceptAll(same).count() == 0
    assert G.generate(prompts, table, "prompt_id", 1, 50.0, 3).count() == prompts.count()
    with pytest.raises(ValueError):
        G.with_temperature(table, 0)


def test_completion(spark):
    df = spark.createDataFrame([([1, 5], [1, 5, 7, 2]), ([1], [1])], "input_ids array<int>, output_ids array<int>")
    assert [r[0] for r in G.completion(df, False).select("answer_ids").collect()] == [[7, 2], []]
    assert [r[0] for r in G.completion(df).select("answer_ids").collect()] == [[1, 5, 7, 2], [1]]


def test_request_contract(spark, vocab, table):
    asked = spark.createDataFrame(
        [(1, "the", 0.5, 5), (2, None, 0.5, 5), (3, "the", None, 5), (4, "the", 0.5, None), (5, "the", 0.0, 5), (6, "the", 0.5, 0)],
        "id int, prompt string, temperature double, max_tokens int",
    )
    for via in ("auto", "join"):
        got = {r.id: r for r in G.predict(asked, vocab, table, "id", via=via).collect()}
        assert got[1].error is None and got[1].generated_text.startswith("the")
        assert [got[i].error for i in range(2, 7)] == [
            "prompt is null",
            "temperature is null",
            "max_tokens is null",
            "temperature must be positive",
            "max_tokens must be at least 1",
        ]
        assert all(got[i].generated_text is None for i in range(2, 7))
    plain = G.predict(asked.where("id = 1").select("id", "prompt"), vocab, table, "id").first()
    assert (plain.temperature, plain.max_tokens) == (1.0, 100) and plain.generated_text
    with pytest.raises(ValueError):
        G.check_requests(asked.drop("prompt"))
    with pytest.raises(TypeError):
        G.check_requests(asked.withColumn("temperature", F.lit("hot")))
    with pytest.raises(TypeError):
        G.check_requests(asked.withColumn("prompt", F.lit(1)))


def test_caller_functions(documents):
    def shout(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(text=rows["text"].str.upper())

    got = G.apply_rows(documents, shout, documents.schema)
    assert got.exceptAll(documents.withColumn("text", F.upper("text"))).count() == 0

    def load():
        return math.sqrt

    def root(model, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": rows["doc_id"], "root": rows["doc_id"].map(model)})

    rooted = G.apply_model(documents, load, root, "doc_id long, root double")
    assert rooted.where(F.abs(F.col("root") - F.sqrt("doc_id")) > 1e-12).count() == 0


def test_models_are_loaded_once_a_worker(spark, tmp_path):
    mark = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(mark, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return 1

    df = spark.range(200).repartition(40)
    got = G.apply_model(df, load, lambda m, rows: rows.assign(one=m), "id long, one long")
    assert got.count() == 200
    import os

    # Once per process; how many processes there are is Spark's affair.
    loads = [name.split("-")[0] for name in os.listdir(mark)]
    assert 1 <= len(loads) == len(set(loads))


def test_predict_with_answers_every_row(spark):
    rows = [(1, "a", 1.0), (2, None, 1.0), (3, "bad", 1.0), (4, "d", float("nan")), (5, "e", float("inf"))]
    df = spark.createDataFrame(rows, "id int, prompt string, temperature double")

    def answer(model, rows):
        if (rows["prompt"] == "bad").any():
            raise ValueError("no answer")
        return rows["prompt"] + model

    got = {r["id"]: (r["generated_text"], r["error"]) for r in G.predict_with(df, lambda: "!", answer).collect()}
    assert got[1] == ("a!", None) and got[2] == (None, "prompt is null")
    assert got[3] == (None, "ValueError: no answer")
    assert got[4] == got[5] == (None, "temperature must be positive")


def test_a_shared_model_is_one_file_for_all_workers(spark):
    table = spark.range(1000).select(F.col("id").alias("prev"), (F.col("id") * 3).alias("next"))
    load = share_table(table, sort_by="prev")

    def look(model, rows):
        with open("/proc/self/maps") as maps:
            mapped = {tuple(line.split()[3:6]) for line in maps if "model-" in line and ".arrow" in line}
        # A column is a view of the file: its values lie in mapped pages.
        address = model.column("next").chunk(0).buffers()[1].address
        with open("/proc/self/maps") as maps:
            ranges = [line.split()[0].split("-") for line in maps if "model-" in line and ".arrow" in line]
        inside = any(int(a, 16) <= address < int(b, 16) for a, b in ranges)
        return pd.DataFrame({"pid": [os.getpid()], "files": [len(mapped)], "file": [str(sorted(mapped))], "inside": [inside]})

    df = spark.range(400).repartition(40)
    got = G.apply_model(df, load, look, "pid long, files long, file string, inside boolean").collect()
    assert {r["files"] for r in got} == {1} and all(r["inside"] for r in got)
    assert len({r["file"] for r in got}) == 1  # device, inode and path


def test_a_model_over_the_limits_is_not_shared(spark, monkeypatch):
    monkeypatch.setattr("sftprep.session.MAX_SHIPPED_ROWS", 3)
    assert share_table(spark.range(4)) is None and share_table(spark.range(3)) is not None


@pytest.mark.parametrize("via", ["auto", "join"])
def test_likeliest_next_tokens(spark, via):
    lm = spark.createDataFrame([(1, 5, 2), (1, 4, 2), (1, 9, 1), (7, 1, 1)], "prev int, next int, n long")
    rows = [(1, [3, 1]), (2, []), (3, None), (4, [1, 8]), (5, [7]), (5, [7]), (None, [1])]
    df = spark.createDataFrame(rows, "doc_id long, input_ids array<int>")
    got = G.with_likeliest(df, G.likeliest(lm), via=via)
    assert got.columns == ["doc_id", "input_ids", "next_id"]
    found = sorted(((r["doc_id"] or 0), r["next_id"]) for r in got.collect() if r["next_id"] is not None)
    assert found == [(0, 4), (1, 4), (5, 1), (5, 1)] and got.count() == 7
    none = G.with_likeliest(df, G.likeliest(lm.limit(0)), via=via)
    assert none.where("next_id is null").count() == 7
    assert G.with_likeliest(df.limit(0), G.likeliest(lm), via=via).count() == 0
