"""Scans in levels, the median built on them, and the lexicon join by shuffle."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from cadenza.operators import scan
from cadenza.operators.frames import median_tempo
from cadenza.operators.sentiment import lexicon_scores, word_filter


@pytest.mark.parametrize("size,levels", [(2, 7), (3, 4), (100, 1)])
def test_levels_against_brute_force(spark, monkeypatch, size, levels):
    """A key with most rows, NULL keys, chunks of two rows; no window is longer than a chunk."""
    rnd, seen = random.Random(size), []
    real = scan._level
    monkeypatch.setattr(scan, "_level", lambda rows, key, outs, n, top: (seen.append(top), real(rows, key, outs, n, top))[1])
    rows = [(rnd.choice(["hot"] * 6 + ["b", None]), i * 7, rnd.choice([None, i])) for i in range(70)]
    df = spark.createDataFrame(rows, "k string, o long, v int").repartition(5)
    got = {(r.k, r.o): (r.p, r.s) for r in scan.before(df, "k", "o", {"p": ("last", "v"), "s": ("sum", "v")}, size).collect()}
    assert len(got) == len(rows)
    for k, o, _ in rows:
        earlier = [v for kk, oo, v in rows if kk == k and oo < o and v is not None]
        assert got[k, o] == (earlier[-1] if earlier else None, sum(earlier))
    assert len(seen) == levels and seen[-1] < size


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, o long, v int")
    assert scan.before(df, "k", "o", {"p": ("last", "v")}).collect() == []


def test_median_of_a_hot_track(spark):
    """One track has a third of the rows, all different; chunks are far smaller than it."""
    rnd = random.Random(1)
    rows = [("hot", rnd.random() * 100) for _ in range(1001)]
    rows += [(f"t{i % 40}", rnd.choice([60.0, 90.5, 120.0, None])) for i in range(1500)] + [(None, float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "t string, tempo double").repartition(7)
    want = {}
    for t, v in rows:
        want.setdefault(t, []).extend([v] if v is not None else [])
    got = {r.t: (r.median_tempo, r.n_frames) for r in median_tempo(df, "t", chunk_rows=64).collect()}
    assert got.keys() == want.keys()
    for t, vs in want.items():
        assert got[t][1] == len(vs) and abs(got[t][0] - statistics.median(vs)) < 1e-9


def test_filter_keeps_every_word(spark):
    words = spark.createDataFrame([(f"w{i}",) for i in range(3000)], "word string")
    other = spark.createDataFrame([(f"x{i}",) for i in range(20000)], "word string")
    may = word_filter(words)
    assert words.where(may("word")).count() == 3000
    assert other.where(may("word")).count() < 200
    tiny = word_filter(words, bits=64)                  # full: lets everything through, loses nothing
    assert words.where(tiny("word")).count() == 3000


def test_shuffled_lexicon_with_a_hot_word(spark):
    docs = spark.createDataFrame([(i % 400, "the The cat " + f"w{i} " * (i % 3)) for i in range(500)] + [(None, "the"), (-1, None), (-2, "none")],
                                 "doc_id int, text string").withColumn("n", F.lit("mine"))
    lex = spark.createDataFrame([("the", 0.5, None), ("cat", 0.25, 0.125), *((f"w{i}", None, 1.0) for i in range(0, 500, 2))],
                                "word string, valence double, arousal double")
    out = [{r.doc_id: (r.lex_valence, r.lex_arousal, r.lex_hits, r.n) for r in
            lexicon_scores(docs, "doc_id", "text", lex, carry=["n"], shuffled=s).collect()} for s in (True, False)]
    assert out[0].keys() == out[1].keys() and len(out[0]) == 403
    for k, a in out[0].items():
        assert a[2:] == out[1][k][2:] and all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-12) for x, y in zip(a[:2], out[1][k][:2]))
