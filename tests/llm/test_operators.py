import math
import re
from collections import defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from sftprep.llm import (
    exact, fingerprints, katz, language, lines, minhash, mixing, quality, substrings, transducer,
)

LONG = " ".join(f"w{i % 701}x{i % 13}" for i in range(9000))
BASE = [f"word{i}" for i in range(60)]
NEAR = BASE[:30] + ["changed"] + BASE[31:]
PASSAGE = " ".join(f"pass{i}" for i in range(45))
LINE = "one two three four five six seven eight nine"
TEXTS = [
    (1, " ".join(BASE)),
    (2, " ".join(NEAR)),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "Two  spaces\tand\nlines"),
    (7, "Two spaces and lines"),
    (8, f"start {PASSAGE} end"),
    (9, f"another {PASSAGE} close"),
    (10, LONG),
    (11, LONG + " tail"),
    (12, " ".join(["same"] * 70)),
    (13, "short text"),
    (14, "short text"),
    (15, f"{LINE}\nmiddle\n{LINE}\n\n{LINE} ten"),
    (16, f"{LINE.replace('four', 'vier')}\nmiddle\nx {LINE}"),
    (17, "日本語 のテキスト 😀 ▁ \u0000 end"),
    (18, "a b c d e f g h i j " * 12),
    (19, "J A b c d e f g h i"),
    (20, " ".join(BASE[::-1])),
    (None, " ".join(BASE)),
    (None, "short text"),
]
CLASHING = ["block", "owner", "band", "chunks", "recipe", "line", "first", "ids", "decoded", "score",
            "label", "topic", "tokens", "row", "key", "n", "component_id", "train", "held_out", "text_sha256"]


def table(spark, rows):
    rows = [(d, t, "en" if i % 2 else None, "src" if i % 3 else None, None) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, TEXTS).repartition(5).cache()


def as_set(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_exact_duplicates(docs):
    got = exact.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert as_set(got.collect()) == as_set(plain.exact(TEXTS))


def test_recipes_tell_clashing_chunks_apart(spark):
    rows = [(1, "a", ["p", "q"]), (2, "b", ["p", "r"]), (3, "c", [])]
    named = spark.createDataFrame(rows, "doc_id long, row string, chunks array<string>")
    clashing = named.select(F.explode("chunks").alias("chunk")).select(F.xxhash64("chunk").alias("id")).distinct()
    got = {r["row"]: tuple(r["recipe"]) for r in exact._told_apart(named, clashing).collect()}
    assert got["a"][:2] == got["b"][:2] and got["a"] != got["b"]


def test_chunks_lose_nothing(spark):
    texts = [LONG, "a" * 10_000, "x. " * 3000, "😀, " * 700, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.withColumn("c", exact.chunks(F.col("text"))).collect():
        assert "".join(r["c"]) == r["text"] and all(len(c) <= exact.CHUNK_MOST for c in r["c"])


def test_near_duplicates(docs):
    got = minhash.near_duplicates(docs).collect()
    assert as_set(got) == as_set(plain.near(TEXTS))


def test_near_duplicates_of_a_large_group(spark):
    """Copies of one text whose copies are too far from each other: only the base links them."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(300)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        own = list(base)
        for at in rng.choice(300, 6, replace=False):
            own[at] = f"n{i}_{at}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base)) for i in range(50)]
    got = minhash.near_duplicates(table(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept")
    assert as_set(got.collect()) == as_set(plain.near(rows))


def test_near_duplicates_among_many_apart(spark):
    """One passage in many texts just under the bound to each other, and pairs just over it."""
    passage = [f"p{i}" for i in range(124)]
    rows = [(i, " ".join(passage + [f"o{i}_{j}" for j in range(24)])) for i in range(400)]
    for i in range(1000, 1080, 2):
        ends = [[f"s{i}_{j}" for j in range(4)] + [f"o{k}_{j}" for j in range(20)] for k in (i, i + 1)]
        rows += [(i + k, " ".join(passage + ends[k])) for k in (0, 1)]
    got = minhash.near_duplicates(table(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 if i >= 1000 else i for i, _ in rows}


def test_links_between_components_are_all_found(spark):
    rng = np.random.default_rng(5)
    bases = [rng.choice(3000, 60, replace=False) for _ in range(6)]
    sets = {}
    for i in range(240):
        base, gone = bases[i % 6], rng.integers(0, 14)
        sets[i] = set(rng.choice(base, len(base) - gone, replace=False).tolist()) | set(rng.integers(0, 3000, rng.integers(0, 14)).tolist())
    component = {i: i - i % 3 for i in sets}
    want = set()
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if component[a] != component[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                want.add((b, a))
    held = spark.createDataFrame(
        [(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in sets.items()], "doc_id long, shingles binary"
    )
    members = spark.createDataFrame(list(component.items()), "doc_id long, component_id long")
    got = minhash.links_between(members, held, 75).collect()
    assert len(want) > 50 and sorted((r["a"], r["b"]) for r in got) == sorted(want)


def test_densification_gives_equal_sets_equal_signatures():
    sets = [np.sort(np.random.default_rng(1).integers(0, 2**63, n, np.uint64)) for n in (1, 3, 3000, 0)]
    a, b = minhash.signatures(sets), minhash.signatures(sets[::-1])[::-1]
    assert (a == b).all() and (a[:3] > 0).all()


def test_bands_find_pairs_at_the_bound():
    """Of pairs at 0.75, at most a few in a thousand share no bucket."""
    rng, missed = np.random.default_rng(2), 0
    for _ in range(1000):
        union = np.sort(rng.integers(0, 2**63, 80, np.uint64) * np.uint64(2))
        a, b = minhash.signatures([union[:70].copy(), np.sort(np.r_[union[:60], union[70:]])])
        keys = minhash.band_keys(np.stack([a, b]))
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 3


def test_substrings(docs):
    got = substrings.repeats_removed(docs).collect()
    assert as_set(got) == as_set(plain.substrings(TEXTS))


def test_substrings_of_small_alphabets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(list("ab"), rng.integers(0, 120)))) for i in range(40)]
    rows += [(100 + i, " ".join(["x"] * i + ["y"] * 21 + ["x"] * (40 - i))) for i in range(0, 40, 3)]
    got = substrings.repeats_removed(table(spark, rows)).collect()
    assert as_set(got) == as_set(plain.substrings(rows))


def test_symbols_of_equal_windows_agree():
    """A symbol that depends on words inside a window stands in each copy of the window."""
    from sftprep.llm.words import words_of
    import pyarrow as pa

    rng = np.random.default_rng(5)
    middle = [f"m{x}" for x in rng.integers(0, 9, 40)]
    texts = [" ".join([f"l{i}", *middle, f"r{i}"]) for i in range(2)]
    symbols = substrings.parsed(words_of(pa.array(texts)))
    inside = [
        {(n, lo - 42 * r) for n, r, lo, hi in zip(symbols.name, symbols.row, symbols.low, symbols.high)
         if r == row and lo - 42 * row >= 1 and hi - 42 * row <= 41}
        for row in (0, 1)
    ]
    assert inside[0] == inside[1] and inside[0]


def test_lines(spark):
    rows = [r for r in TEXTS if r[0] is not None]
    got = lines.line_dedup(table(spark, rows)).collect()
    assert as_set(got) == as_set(plain.lines(rows))


def test_lines_under_random_edits(spark):
    rng, rows = np.random.default_rng(6), []
    for i in range(60):
        own = []
        for _ in range(5):
            line = [f"t{x}" for x in range(int(rng.integers(6, 11)))]
            for _ in range(int(rng.integers(0, 3))):
                at, what = int(rng.integers(0, len(line))), rng.integers(0, 3)
                line[at : at + (what > 0)] = [f"t{rng.integers(0, 4)}"] if what < 2 else []
            own.append(" ".join(line))
        rows.append((i, "\n".join(own)))
    got = lines.line_dedup(table(spark, rows)).collect()
    assert as_set(got) == as_set(plain.lines(rows))


def test_short_and_unspaced_lines_under_random_edits(spark):
    rng, rows = np.random.default_rng(8), []
    bases = ["page 12 of the annual report", "\u6771\u4eac\u90fd\u306b\u4f4f\u3093\u3067\u3044\u308b\u4eba\u3005\u306e\u751f\u6d3b\u3068\u6587\u5316\u306b\u3064\u3044\u3066" * 3,
             "a b c d e f g", "short one", "aaaaaaaaaaaaaaaa", "\U0001f600" * 17, "x" * 5000]
    for i in range(60):
        own = []
        for _ in range(4):
            line = list(bases[int(rng.integers(0, len(bases)))])
            for _ in range(int(rng.integers(0, 3))):
                at, what = int(rng.integers(0, len(line))), rng.integers(0, 3)
                line[at : at + (what > 0)] = ["ab \u6587\U0001f601"[rng.integers(0, 5)]] if what < 2 else []
            own.append("".join(line))
        rows.append((i, "\n".join(own)))
    got = lines.line_dedup(table(spark, rows)).collect()
    want = plain.lines(rows)
    assert as_set(got) == as_set(want)
    assert sum(r[4] for r in want) > 20


def test_words_and_characters_are_not_mixed(spark):
    rows = [(1, "abcdefghijklmnop"), (2, "a b c d e f g h i j k l m n o p"), (3, "a b c d e f g h i j k l m n o q"),
            (4, "abcdefghijklmnoq"), (5, "abcdefghijklmno")]
    got = {r["doc_id"]: r["n_near"] for r in lines.line_dedup(table(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0}


def test_rows_without_id_keep_their_lines(spark):
    got = lines.line_dedup(table(spark, [(None, f"{LINE}\n{LINE}"), (1, LINE)])).collect()
    assert as_set((r["doc_id"], r["text"]) for r in got) == as_set([(None, f"{LINE}\n{LINE}"), (1, LINE)])


def test_katz(docs):
    training = [plain.remainder(d, 5) != 1 for d, _ in TEXTS]
    want, probability, following, uni = plain.katz(TEXTS, training, katz.Discounts, katz.Discounts)
    names = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = as_set(katz.held_out_scores(docs).select(*names).collect())
    for a, b in zip(got, as_set(want)):
        assert a[:4] == b[:4] and all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(a[4:], b[4:]))
    for v in list(following)[:20]:
        assert math.isclose(sum(probability(v, w) for w in uni) + probability(v, "never seen"), 1.0)


def test_katz_without_training_rows(docs):
    got = katz.katz_scores(docs, F.lit(False)).collect()
    assert len(got) == len(TEXTS) and all(r["train_tokens"] == 0 and r["score"] == 0.0 for r in got)


def test_round_trip(docs):
    got = transducer.round_trip(docs).collect()
    assert len(got) == len(TEXTS) and all(r["exact"] for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == 0 and by_id[13]["ids_hash"] == by_id[14]["ids_hash"]


def test_shortest_path_is_the_cheapest():
    with open(transducer.MODEL, "rb") as file:
        machine = transducer.pieces_of(file.read())
    known = {s: i for i, s in enumerate(machine.spelled) if s and i not in set(machine.byte_id.tolist())}
    for text in (" the cats", " unbelievable", " ▁x", " über 日"):
        data = text.encode()
        best = [0.0] + [math.inf] * len(data)
        for i in range(len(data)):
            best[i + 1] = min(best[i + 1], best[i] + transducer.FALLBACK_WEIGHT)
            for j in range(i + 1, len(data) + 1):
                if data[i:j] in known:
                    best[j] = min(best[j], best[i] + float(machine.weight[known[data[i:j]]]))
        ids, _ = machine.encode(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        own = sum(
            transducer.FALLBACK_WEIGHT if i in machine.byte_id else float(machine.weight[i]) for i in ids.tolist()
        )
        assert math.isclose(own, best[-1], rel_tol=1e-5)


def test_spans_and_extensions():
    a, b = fingerprints.PrefixHashes("the quick brown fox"), fingerprints.PrefixHashes("a quick brown dog")
    assert a.same(4, b, 2, 11) and not a.same(4, b, 2, 13)
    assert a.extension(4, b, 2) == len("quick brown ") and a.extension(0, b, 0) == 0


def test_fingerprints(docs):
    got = fingerprints.fingerprints(docs).collect()
    known = sorted((r for r in TEXTS if r[0] is not None), key=lambda r: -r[0])
    unknown = sorted((r for r in TEXTS if r[0] is None), key=lambda r: r[1])
    ordered = [(d, t or "") for d, t in known + unknown]
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        want.append((doc_id, len(text), plain.sha(text[: len(text) - half] + following[:half])))
    assert as_set((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == as_set(want)
    by_text = defaultdict(set)
    texts = dict(TEXTS)
    for r in got:
        if r["doc_id"] is not None:
            by_text[texts[r["doc_id"]] or ""].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(prints) == 1 for prints in by_text.values())
    near = {r["doc_id"]: r for r in got}
    assert near[11]["near_next"] > 0.9 and near[14]["near_next"] == 1.0 and near[20]["near_next"] < 0.1


def test_one_row_follows_itself(spark):
    row = fingerprints.fingerprints(table(spark, [(1, "abcdef")])).first()
    assert row["edited_sha256"] == plain.sha("abcabc") and row["near_next"] == 1.0


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.held_out_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.99 * n


def test_languages_equal_dense_profiles(spark):
    """Bundles against plain sums over trigrams, in three scripts with many letters."""
    rng, rows = np.random.default_rng(4), []
    scripts = {"latin": range(97, 123), "cyrillic": range(0x430, 0x450), "han": range(0x4E00, 0x5E00)}
    for i in range(60):
        lang = list(scripts)[i % 3]
        text = "".join(chr(rng.choice(scripts[lang])) if rng.random() < 0.8 else " " for _ in range(400))
        rows.append((i, text, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = docs.where("doc_id < 30")

    def profile(text):
        # A run of spaces after a letter is one gap, also at the end.
        line = [0] + [0 if c == " " else ord(c) for c in re.sub(" +", " ", text.lstrip())] + [0]
        total, signs = np.zeros(64), lambda p: language.letter_vectors(np.array([p]), 64)[0].astype(float)
        for a, b, c in zip(line, line[1:], line[2:]):
            total += np.roll(signs(a), 2) * np.roll(signs(b), 1) * signs(c)
        return total

    vectors = {i: profile(t) for i, t, _ in rows}
    known = {x: sum(vectors[i] for i, _, lang in rows if i < 30 and lang == x) for x in scripts}
    for r in language.identify(docs, train.select("text", "lang"), dimensions=64).collect():
        own = vectors[r["doc_id"]]
        cosine = {x: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for x, v in known.items()}
        assert math.isclose(r["score"], max(0.0, *cosine.values()), abs_tol=1e-4)
        assert math.isclose(cosine[r["lang_pred"]], max(cosine.values()), abs_tol=1e-4)


def test_letters_have_vectors_of_their_own():
    han = np.arange(0x4E00, 0x9FFF)
    vectors = np.concatenate([language.letter_vectors(np.r_[0, 97:123], 256), language.letter_vectors(han, 256)])
    assert len(np.unique(vectors, axis=0)) == len(vectors)


def test_languages_of_odd_texts(docs):
    got = {r["doc_id"]: r for r in language.held_out_languages(docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 for i in (3, 4, 5))
    assert got[13]["lang_pred"] == "en" and 0 < got[13]["score"] <= 1
    nothing = language.identify(docs, docs.select("text", "lang").limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.held_out_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.93 * len(got)


def test_quality_of_odd_texts(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (10, 0), (99, 0)], "doc_id long, label int")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert got[3]["score"] == got[4]["score"] == 0.5 and got[2]["score"] > got[11]["score"]
    nothing = quality.quality_scores(docs, labels.limit(0)).collect()
    assert len(nothing) == len(TEXTS) and {r["score"] for r in nothing} == {0.5}


def test_mixing_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mixed(docs).cache()
    had = got.agg(F.sum("n_tokens")).first()[0]
    assert abs(got.agg(F.sum(F.col("n_tokens") * F.col("keep_probability"))).first()[0] / had - mixing.SHARE) < 0.01
    for axis in mixing.AXES:
        shares = {r[axis]: r for r in got.groupBy(axis).agg(
            F.sum("n_tokens").alias("had"), F.sum(F.col("n_tokens") * F.col("weight")).alias("now")).collect()}
        powered = sum(r["had"] ** mixing.TEMPER[axis] for r in shares.values())
        for r in shares.values():
            assert math.isclose(r["now"], had * r["had"] ** mixing.TEMPER[axis] / powered, rel_tol=1e-4)
    kept = got.where("kept").agg(F.sum("n_tokens")).first()[0]
    assert abs(kept / had - mixing.SHARE) < 0.05


def _cells(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, tokens long")


def test_raking_equals_plain_rounds_and_needs_many(spark):
    # Cells that carry next to nothing couple the axes: this takes many rounds.
    rows = [("a", "x", 1000), ("a", "y", 1), ("b", "x", 1), ("b", "y", 1000)]
    to = {"source": {"a": 1200.0, "b": 802.0}, "lang": {"x": 900.0, "y": 1102.0}}
    weight = {(s, l): float(t) for s, l, t in rows}
    for _ in range(5000):
        for place, axis in enumerate(to):
            had = {v: sum(w for k, w in weight.items() if k[place] == v) for v in to[axis]}
            weight = {k: w * to[axis][k[place]] / had[k[place]] for k, w in weight.items()}
    targets = {a: spark.createDataFrame(list(v.items()), f"{a} string, target double") for a, v in to.items()}
    got = mixing.raked(_cells(spark, rows), targets).collect()
    for r in got:
        assert math.isclose(r["weight"], weight[r["source"], r["lang"]], rel_tol=1e-3, abs_tol=1e-2)
        assert max(r["off_source"], r["off_lang"]) <= mixing.CLOSE


def test_raking_tells_when_targets_contradict(spark):
    rows = [("a", "x", 10), ("b", "y", 10)]
    to = {"source": [("a", 15.0), ("b", 5.0)], "lang": [("x", 5.0), ("y", 15.0)]}
    targets = {a: spark.createDataFrame(v, f"{a} string, target double") for a, v in to.items()}
    got = {r["source"]: r for r in mixing.raked(_cells(spark, rows), targets).collect()}
    assert got["a"]["off_lang"] == 0 and math.isclose(got["a"]["off_source"], 10 / 15)
    assert math.isclose(got["b"]["off_source"], 2.0)


def test_mixing_of_odd_rows(docs):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(TEXTS)
    assert all(r["kept"] and r["keep_probability"] == 1.0 for r in got if r["n_tokens"] == 0)
    assert {r["source"] for r in got} == {"", "src"} and {r["lang"] for r in got} == {"", "en"}


OPERATORS = {
    "exact": exact.exact_duplicates, "near": minhash.near_duplicates, "substrings": substrings.repeats_removed,
    "lines": lines.line_dedup, "katz": katz.held_out_scores, "pieces": transducer.round_trip,
    "fingerprints": fingerprints.fingerprints, "language": language.held_out_languages, "mixing": mixing.mixed,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_stay_rows(spark, name):
    rows = [(1, LINE), (1, LINE), (2, LINE), (2, None), (2, None), (3, "x")]
    assert sorted(r["doc_id"] for r in OPERATORS[name](table(spark, rows)).collect()) == [1, 1, 2, 2, 2, 3]
