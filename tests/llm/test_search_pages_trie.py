import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import TEXTS, table

from sftprep.llm import balls, html, store, trie

ITEMS = [(1, "The short TEXT, twice: text"), (2, None), (3, ""), (4, "word3 word5 word59 vier"), (5, "日本語 の"),
         (6, "nowhere-found"), (None, "same w1x1"), (1, "The short TEXT, twice: text")]


def ranked(spark, rows, items, **more):
    docs = table(spark, rows)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    got = balls.ranked(docs, asked, **more).select("item_id", "rank", "doc_id", "score").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("top", [1, 3, 20])
def test_search_equals_plain(spark, top):
    rows = TEXTS + [(i, "short text again") for i in range(100, 140)]
    want = plain.search(rows, sorted(set(ITEMS), key=str), top)
    assert ranked(spark, rows, ITEMS, top=top) == sorted(want, key=str)


def test_search_in_blocks_of_queries_and_small_trees(spark, monkeypatch):
    draw = random.Random(5)
    names = [f"n{i}" for i in range(300)]
    rows = [(i, " ".join(draw.choices(names, k=draw.randrange(60)))) for i in range(700)]
    items = [(i, " ".join(draw.choices(names, k=8))) for i in range(9)]
    monkeypatch.setattr(balls, "QUERY_BYTES", 300)
    assert ranked(spark, rows, items, top=7) == sorted(plain.search(rows, items, 7), key=str)


def test_balls_hold_what_they_bound():
    draw = np.random.default_rng(3)
    sizes = draw.integers(1, 30, 500)
    first = np.r_[0, np.cumsum(sizes)]
    term = np.concatenate([np.sort(draw.choice(400, s, replace=False)) for s in sizes])
    impact = draw.integers(1, 1_000_000, len(term))
    tree = balls.Tree(first, term, impact, leaf_docs=4)
    assert sorted(tree.order.tolist()) == list(range(500)) and tree.levels == 7
    dense = np.zeros((500, 400), np.int64)
    dense[np.repeat(np.arange(500), sizes), term] = impact
    for _ in range(20):
        own = np.sort(draw.choice(400, 12, replace=False))
        q = draw.integers(1, 9000, 12)
        scores = dense[:, own] @ q
        here = np.isin(own, tree.known)
        upper = tree.upper_bounds(np.searchsorted(tree.known, own[here]), q[here])
        leaves = upper[(1 << tree.levels) - 1 :]
        for i, (a, b) in enumerate(zip(tree.bounds, tree.bounds[1:])):
            assert scores[tree.order[a:b]].max(initial=0) <= leaves[i]
        assert scores.max() <= upper[0]
        best = balls.Best(5)
        best.over(np.arange(500), np.zeros(500, bool))
        scored = tree.search(own, q, best)
        assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:5] and scored <= 500


def test_search_leaves_most_documents_unscored():
    """Texts of two vocabularies: balls of the other one are never opened."""
    draw = random.Random(1)
    rows = [[f"{'ab'[i % 2]}{draw.randrange(40)}" for _ in range(30)] for i in range(2000)]
    words = balls.terms_of(pa.array([" ".join(r) for r in rows]))
    known, place, _ = balls.ranks(words.name)
    keys, _, tf = balls.ranks(words.row * 100 + place)
    row, term = np.divmod(keys, 100)
    first = np.searchsorted(row, np.arange(2001))
    tree = balls.Tree(first, term, balls.impacts(tf, np.full(len(tf), 30), 2000, 60000))
    best = balls.Best(20)
    best.over(np.arange(2000), np.zeros(2000, bool))
    own = np.unique(place[words.row == 0])
    assert tree.search(own, np.full(len(own), 700), best) < 1100


def test_byte_slices():
    texts = ["x" * 10_000] * 300 + [None, "", "y" * 3_000_000, "z"]
    parts = list(store.byte_slices(pa.RecordBatch.from_pydict({"t": pa.array(texts)}), "t"))
    assert sum((p.column("t").to_pylist() for p in parts), []) == texts
    assert max(p.nbytes for p in parts if p.num_rows > 1) < 1.2 * store.SLICE_BYTES
    assert list(store.byte_slices(pa.RecordBatch.from_pydict({"t": pa.array([], pa.string())}), "t")) == []


PAGES = [
    (None, []), ("", []), ("plain words", ["plain words"]),
    ("<nav>menu</nav>", []),
    ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a>x</a></nav>"
     "<article><h1>A &amp; B</h1><p>One\n two&nbsp;three<br>four <b>five</b>.<p>Six<ul><li>a<li>b</ul>"
     "<script>var a='</p><p>no';</script><!-- no --></article><aside>side</aside><footer>&copy; foot</footer>",
     ["A & B", "One two three four five.", "Six", "a", "b"]),
    ("<main><div class='cookie-notice'>We use cookies</div><form>Name <input></form><p>Text</p>"
     "<section id=comments><article class=comment><p>First!</p></article></section></main>", ["Text"]),
    ("<div class='top'><a>a</a> <a>b</a> <a>c</a></div><div id=x><p>" + "long words " * 30 + "</p><p>Short.</p></div>"
     "<div><ul><li><a>k</a><li><a>l</a><li><a>m</a></ul></div><div class=ad>" + "Buy now " * 90 + "</div>",
     [" ".join(["long words"] * 30), "Short."]),
    ("<p>unclosed <b>bold <p>next</div></p></span> text", ["unclosed bold", "next", "text"]),
    ("<article><p>caf&eacute; &#x65E5;&#26412; &lt;tag&gt; &unknown; 5 < 6</article>", ["café 日本 <tag> &unknown; 5 < 6"]),
    ("<article><svg><text>no</text></svg><table><tr><td>1<td>2<tr><td>3</table></article>", ["1", "2", "3"]),
    ("<article>a<span hidden>b</span>c<span aria-hidden=true>d</span></article>", ["a", "c"]),
    ("<article><script>never closed <p>x</p>", []), ("<div", []), ("</p></div>", []),
]


@pytest.mark.parametrize("page, blocks", PAGES)
def test_blocks_of_pages(page, blocks):
    assert html.blocks_of(page) == blocks


def test_extract(spark):
    rows = [(i // 2 or None, f"u{i}", p) for i, (p, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(tuple(r) for r in html.extract(pages).select("url", "text", "n_chars").collect())
    want = ["\n\n".join(b) for _, b in PAGES]
    assert got == sorted((f"u{i}", t, len(t)) for i, t in enumerate(want))
    assert html.extract(pages.limit(0)).collect() == []
    again = html.extract(pages.where("url = 'u4'").union(pages.where("url = 'u4'")))
    assert again.count() == 2 and again.columns == ["page_id", "url", "text", "n_chars"]


def test_extract_keeps_long_pages_whole():
    page = "<article>" + "".join(f"<p>{i} " + "word " * 40 + "</p>" for i in range(20_000)) + "</article>"
    assert len(html.blocks_of(page)) == 20_000


def test_smoothing_and_threshold():
    assert np.allclose(html.smoothed(np.full(9, 3.0)), 3.0)
    assert 2 < html.threshold(np.array([0.0, 1.0, 2.0, 50.0, 60.0])) < 50
    assert html.threshold(np.array([4.0, 4.0])) == 4.0


TURNS = [
    (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (0, 3, "assistant", "dd"),
    (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "é😀"), (2, 5, None, None), (2, None, "user", "x"),
    (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "assistant", "a"), (7, 1, "", ""), (150, 0, "user", "a"),
    (151, 0, "user", "a"), (199, 0, "user", "z"), (-5, 0, "user", "a"), (None, 0, "user", "gone"),
] + [(200, i, "user", f"t{i}") for i in range(37)] + [(c, i, "user", f"t{i}") for c in (201, 207, 233) for i in range(c - 190)]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(spark, turns):
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = trie.conversation_trie(rows.withColumn("depth", F.lit("x")).withColumn("item", F.lit(1)))
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


def test_trie_equals_plain(spark):
    assert nodes(spark, TURNS) == sorted(plain.trie(TURNS), key=str)


def test_trie_of_nothing(spark):
    assert nodes(spark, TURNS[:0]) == nodes(spark, [(None, 1, "user", "x")]) == []
    # Conversations without a turn of their own left, and a family without a first one.
    alone = [(c, 0, "user", "x") for c in range(101, 140)]
    assert nodes(spark, alone) == sorted(plain.trie(alone), key=str)


def test_trie_with_small_ranges(spark, monkeypatch):
    """Long conversations and long lists of ends lie in many ranges."""
    monkeypatch.setattr(trie, "ID_RANGE", 3)
    monkeypatch.setattr(trie, "TURN_RANGE", 4)
    monkeypatch.setattr(trie, "HEAVY_NODES", 1)
    same = [(c, t, "user", "same") for c in range(40) for t in range(6)]
    assert nodes(spark, TURNS[18:] + same) == sorted(plain.trie(TURNS[18:] + same), key=str)
