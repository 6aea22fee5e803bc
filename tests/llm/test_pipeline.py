import corpus_pipeline as pipeline
import plain
from pyspark.sql import functions as F
from test_operators import TEXTS, table

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_on_odd_rows(spark):
    docs = table(spark, TEXTS).select(*DOCUMENTS)
    named = pipeline.language_id(spark, docs, "")
    assert named.columns == DOCUMENTS and ids(named) == {d for d, _ in TEXTS} - {3, 4, 5}
    unlike = pipeline.exact_dedup(spark, docs, "")
    want = {r[0] for r in plain.exact(TEXTS) if r[3] or r[0] is None}
    assert unlike.columns == DOCUMENTS and ids(unlike) == want
    apart = pipeline.minhash_near_dedup(spark, docs, "")
    assert ids(apart) == {r[0] for r in plain.near(TEXTS) if r[3]} and apart.columns == DOCUMENTS
    mixed = pipeline.mixing(spark, docs, "")
    assert ids(mixed) <= {d for d, _ in TEXTS} and mixed.columns == DOCUMENTS
    encoded = pipeline.sentencepiece_encoding(spark, docs, "")
    assert encoded.count() == len(TEXTS) and encoded.where("not exact or n_tokens <> size(ids)").count() == 0


def test_lettered_texts_stay_when_no_language_is_known(spark):
    docs = table(spark, TEXTS).select(*DOCUMENTS).withColumn("lang", F.lit(None).cast("string"))
    assert ids(pipeline.language_id(spark, docs, "")) == {d for d, _ in TEXTS} - {3, 4, 5}
    held_out = docs.withColumn("lang", F.lit("en")).where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    left = ids(held_out)
    assert left and ids(pipeline.language_id(spark, held_out, "")) == left - {3, 4, 5}


def test_stages_on_an_empty_table(spark):
    docs = table(spark, TEXTS).select(*DOCUMENTS).limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Every text of this table has letters, so language ID drops none of them.
    left = [r for r, e in zip(rows, plain.exact(rows)) if e[3]]
    left = {r[0] for r, n in zip(left, plain.near(left)) if n[3]}
    found = pipeline.run(spark, SMALL)
    got = ids(found)
    assert got <= left and len(got) >= 0.75 * len(left)
    assert found.where(~F.col("exact")).count() == 0
    assert pipeline.ORACLE_SQL is None and len(pipeline.STAGES) == 5
