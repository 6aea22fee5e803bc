"""What grows with the input: pairs of near-duplicate search, memory of worker functions."""

import math
import random
import tracemalloc

import numpy as np
import plain
import pyarrow as pa
import pytest
from test_operators import table

from sftprep.llm import balls, html, language, minhash, quality, store, transducer
from sftprep.llm.words import words_of


def compared(spark, monkeypatch, rows):
    """Pairs compared on full sets, and the component of each document."""
    pairs, confirmed = [], minhash._confirmed

    def counting(found, sets, percent):
        found = store.keep(found)
        pairs.append(found.count())
        return confirmed(found, sets, percent)

    monkeypatch.setattr(minhash, "_confirmed", counting)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table(spark, rows)).collect()}
    monkeypatch.setattr(minhash, "_confirmed", confirmed)
    return sum(pairs), got


def slots(n):
    """Texts of one template with eight slots of twelve values each."""
    draw = random.Random(n)
    out = []
    for i in range(n):
        words = [f"t{j}" for j in range(100)]
        for k in range(8):
            words[12 * k + 3] = f"s{k}v{draw.randrange(12)}"
        out.append((i, " ".join(words)))
    return out


def near_copies(n):
    base = [f"b{j}" for j in range(200)]
    return [(i, " ".join(base[: i % 199] + [f"own{i}"] + base[i % 199 + 1 :])) for i in range(n)]


def one_passage(n):
    """A shared passage with own words around: just below a link, but for one pair."""
    passage = " ".join(f"p{j}" for j in range(124))
    out = [(i, passage + " " + " ".join(f"d{i}x{j}" for j in range(24))) for i in range(n)]
    return out + [(n, out[n // 2][1] + " more")]


@pytest.mark.parametrize("corpus", [slots, near_copies, one_passage])
def test_pairs_grow_with_the_texts(spark, monkeypatch, corpus):
    few, _ = compared(spark, monkeypatch, corpus(250))
    many, got = compared(spark, monkeypatch, corpus(1000))
    assert math.log(many / few, 4) <= 1.1, (few, many)
    if corpus is near_copies:
        assert set(got.values()) == {0} and many < 4 * 1000
    if corpus is one_passage:
        assert [d for d, c in got.items() if d != c] == [1000] and got[1000] == 500


def test_slots_lose_no_link(spark, monkeypatch):
    rows = slots(400)
    assert compared(spark, monkeypatch, rows)[1] == {r[0]: r[2] for r in plain.near(rows)}


def test_bitmaps_differ_in_at_most_what_sets_differ_in():
    sets = minhash.shingle_sets(words_of(pa.array([t for _, t in slots(60) + near_copies(60)])))
    drawn = minhash.bitmaps(sets).view(np.uint64)
    for i in range(0, 120, 7):
        for j in range(120):
            bits = sum(int(x).bit_count() for x in drawn[i] ^ drawn[j])
            assert bits <= len(np.setxor1d(sets[i], sets[j]))


def test_repeated_ids_with_different_texts_do_not_depend_on_row_order(spark):
    a, b = near_copies(2)[0][1], " ".join(f"z{i}" for i in range(80))
    rows = [(5, a), (5, b), (6, a + " x"), (7, b + " x"), (8, "other words entirely here now")]
    want = sorted(map(tuple, minhash.near_duplicates(table(spark, rows)).collect()))
    assert sorted(map(tuple, minhash.near_duplicates(table(spark, rows[::-1])).collect())) == want


WORK = {
    "language counts": lambda: language._bundles(),
    "language names": lambda: language._named(["en"], np.ones((1, 256), np.float32), 256),
    "sketches": lambda: minhash._sketch(256, 5, 5),
    "full sets": lambda: minhash._full_sets(5),
    "quality features": lambda: quality._sparse,
    "search vectors": lambda: balls._vectors(np.arange(500, dtype=np.uint64)),
    "pages": lambda: html._extract(1.0),
}


@pytest.mark.parametrize("name", WORK)
def test_memory_of_one_large_batch(name):
    """Ten thousand rows of three kilobytes each arrive at once."""
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefghijklmnop", k=5)) for _ in range(3000)]
    texts = [" ".join(draw.choices(words, k=500)) for _ in range(200)] * 50
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(n), pa.int64()), "page_id": pa.array(range(n), pa.int64()),
        "url": pa.array([""] * n), "text": pa.array(texts), "html": pa.array(texts),
        "lang": pa.array(["en", "de"] * (n // 2)), "label": pa.array([1] * n, pa.int32()),
    })
    run = WORK[name]()
    language.lower_letters()
    tracemalloc.start()
    rows = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows and peak < 130 << 20, peak >> 20
