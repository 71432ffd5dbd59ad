"""Main text of pages: reading, decoding, held-out accuracy."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import html_text as h


@pytest.fixture(scope="module")
def model():
    return h.train()


def blocks(source):
    return [t for _, t, _ in h.read_page(source).blocks]


@pytest.mark.parametrize("source,want", [
    ("", []), ("   ", []), ("plain  text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b</b>\n c</p>d", ["a b c", "d"]),
    ("<p>a&amp;b &eacute; &#233; &am</p>", ["a&b é é &am"]), ("<p>x<script>if (a<b) '</p>'</script>y", ["x y"]),
    ("<p>x<!-- <p>no --> y", ["x y"]), ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<p>a < b > c", ["a < b > c"]),
    ('<p title="a>b">x</p>', ["x"]), ("<p title='open>x</p><p>y", ["x", "y"]), ("<style>p{}", []), ("<p>a<br>b", ["a b"]),
    ("</div></p>x</body></html>y", ["x", "y"]), ("<textarea>no</textarea><p>x&nbsp;&nbsp;y", ["x y"]), ("<", ["<"]), ("<p", []),
    ("<p>The formula <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>", ["The formula x=2 holds."]),
    ("<p>a <noscript>b</noscript> c</p><noscript><p>d</p><p>e</p></noscript>f", ["a b c", "d", "e", "f"]),
    ("<object data=x><p>one</p>two</object><svg/>three", ["one", "two", "three"]), ("<select><option>no</select><p>x", ["x"]),
    ("<p title='open>x</p><p class=\"a>b\">y</p><p id=\"c>d\">z", ["x", "y", "z"])])
def test_blocks(source, want):
    assert blocks(source) == want


def test_embedded_elements_are_judged_on_their_own():
    p = h.read_page("<div><noscript><p>a</p></noscript><svg><text>b</text></svg></div>")
    assert p.tag[1:] == ["div", "noscript", "p", "svg"] and [(p.tag[e], t) for e, t, _ in p.blocks] == [("p", "a"), ("svg", "b")]


@pytest.mark.parametrize("unit", ['<p ">"', "<p \"'>", "<p '\">", '<p "> ', "<p"])
def test_quotes_that_never_match_take_linear_time(unit):
    import time
    start = time.perf_counter()
    h.read_page(unit * 60_000 + '"')
    assert time.perf_counter() - start < 5


def test_parents_come_first_and_ends_are_implied():
    p = h.read_page("<div><p>a<div>b</div></div><table><tr><td>c<td>d<tr><td>e</table>")
    assert all(a < k for k, a in enumerate(p.parent) if k)
    assert [p.tag[p.parent[k]] for k, t in enumerate(p.tag) if t == "td"] == ["tr"] * 3


def test_decoding_is_the_best_consistent_choice():
    rnd = random.Random(0)
    for _ in range(60):
        n = rnd.randint(1, 9)
        page = h.Page(parent=[-1] + [rnd.randrange(k) for k in range(1, n)], tag=["div"] * n)
        s = [rnd.uniform(-4, 4) for _ in range(n)]
        gain = lambda kept: sum(x / 2 if y else -x / 2 for x, y in zip(s, kept))
        legal = [y for y in itertools.product((False, True), repeat=n) if all(y[page.parent[k]] or not y[k] for k in range(1, n))]
        assert gain(h.decode(page, s)) == pytest.approx(max(map(gain, legal)))


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4)).astype(np.float32)
    y = ((x[:, 0] > .5) ^ (x[:, 1] > .3)).astype(float)
    t = h.Trees.fit(x[:1500], y[:1500], np.ones(1500), trees=30)
    assert (((t.scores(x[1500:]) > 0) == y[1500:]).mean()) > 0.95


def test_held_out_pages(model):
    kept = wrong = missed = 0
    for s in h.training_pages(150, seed=12345):
        p = h.read_page(s)
        want = Counter(t for e, t, _ in p.blocks if " data-main" in f" {p.attrs[e]}")
        got = Counter(h.extract_all([s], model)[0].split("\n"))
        kept, wrong, missed = kept + sum((want & got).values()), wrong + sum((got - want).values()), missed + sum((want - got).values())
    assert kept / (kept + wrong) > 0.97 and kept / (kept + missed) > 0.95


def test_pages_of_the_table(spark, model):
    from cadenza.llm.base import prepare
    prepare(spark)
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in h.main_texts(rows, model).collect()}
    right = 0
    for r in rows.collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        right += got[r.page_id] == "\n".join(blocks(inside))
    assert len(got) == rows.count() and right >= 0.98 * len(got)


def test_odd_rows(spark, model):
    from cadenza.llm.base import prepare
    from pyspark.sql import functions as F
    prepare(spark)
    page = "<article><h1>A title here</h1>" + "<p>Some words of the article stand here, and more follow.</p>" * 3000 + "</article>"
    rows = [(1, None, None), (None, "u", ""), (3, "u", page), (3, "u", page), (4, "u", "<div>" * 3000 + "deep"), (5, "u", "<p" * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = h.main_texts(df, model).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[None] == "" and by[3].count("\n") == 3000
    assert h.main_texts(df.limit(0), model).count() == 0
