"""Wu-Manber search against looking at every window."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import decontaminate as d
from llm_fixtures import docs, texts  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(UPPER))


def plain(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add("" if i is None else str(i))
    sizes = {len(g) for g in wins}
    out = Counter()
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = tuple(w[k:k + n])
                if g in wins:
                    hit.update(range(k, k + n))
                    found |= wins[g]
        out[i, len(w), len(hit), ",".join(sorted(found))] += 1
    return out


def test_words_equal_the_pattern(texts):
    for t in [*texts.values(), "Ä a-B_c\x7f9 é\xa0x", "", "漢字 İ ſ K"]:
        assert [w.decode() for w in d.words_of(t)] == words(t)


def test_search_finds_all_occurrences():
    rnd = random.Random(1)
    for _ in range(150):
        text = bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(0, 400)))
        pats = {bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(1, 20))) for _ in range(rnd.randint(1, 12))}
        pats |= {text[k:k + rnd.randint(5, 40)] for k in (3, 50, 90) if len(text) > 140}
        want = {(i, p) for p in pats for i in range(len(text)) if text.startswith(p, i)}
        assert set(d.WuManber(sorted(pats)).find(text)) == want


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_hits_equal_the_plain_version(spark, docs, texts, block):
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rnd = random.Random(3)
    items = bench[:20] + [(900, "short item"), (901, None), (902, "..."), (None, "of no id " + bench[0][1]), (903, bench[1][1]), (20, bench[2][1])]
    items += [items[0], (0, "another text under an id that is taken already by one")]
    rows = [*texts.items(), (None, None), (1, ""), (2, "Short, ITEM."), (2, "Short, ITEM."), (5000, f"x {bench[0][1]} y {bench[0][1]}"),
            (5001, " ".join(rnd.choice(bench)[1] for _ in range(300)))]
    bench_df = spark.createDataFrame(items, "item_id long, text string").withColumn("hit_items", F.lit("x"))
    df = docs(rows).withColumn("item", F.lit("x"))
    got = d.contamination(df, bench_df, block_bytes=block)
    assert got.columns == [*(c for c in df.columns if c not in ("n_words", "hit_spans")), "n_words", "hit_spans", "hit_items"]
    found = Counter((r.doc_id, r.n_words, sum(x.b - x.a for x in r.hit_spans), ",".join(r.hit_items)) for r in got.collect())
    assert found == plain(rows, items)


def test_an_id_with_a_third_of_the_benchmark_is_spread(spark, docs):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("Red blue green, odd even high low 7 été".split()) for _ in range(n))
    hot = [(7, text(40)) for _ in range(60)] + [(None, text(3000)), (9, text(5)), (10, "")]
    items = hot + [(100 + k, text(40)) for k in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(d.item_blocks(bench, 2000, 10))
    sizes = [sum(len(t.encode()) for _, t in b) for b in blocks]
    assert len(blocks) > 8 and max(sizes) < 3 * 2000
    assert {(i, w) for b in blocks for i, t in b for w in d.windows_of(d.words_of(t))} == {
        ("" if i is None else str(i), w) for i, t in items for w in d.windows_of(d.words_of(t))}
    rows = [(1, text(200)), (2, hot[60][1][50:400]), (3, "x " + hot[3][1] + " y"), (4, text(5))]
    got = d.contamination(docs(rows), bench, block_bytes=6000).collect()
    found = Counter((r.doc_id, r.n_words, sum(x.b - x.a for x in r.hit_spans), ",".join(r.hit_items)) for r in got)
    assert found == plain(rows, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(docs([], extra=False), none).count() == 0
    rows = d.contamination(docs([(1, "a b c")], extra=False), none).collect()
    assert [(r.n_words, r.hit_spans, r.hit_items) for r in rows] == [(3, [], [])]
