"""Sentiment: broadcast and shuffled joins agree (JOI-9, AGG-3, JOI-11, NUM-5)."""

from pyspark.sql import functions as F

from cadenza.operators.sentiment import lexicon_scores, lyric_sentiment
from cadenza.plans.lyrics import benchmark_lexicon

SF = "/root/testdata/sf0.001"


def _collect(df, key="doc_id"):
    return {r[key]: tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()}


def test_lexicon_paths_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    lex = benchmark_lexicon(spark, SF)
    small = _collect(lexicon_scores(docs, "doc_id", "text", lex))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = _collect(lexicon_scores(docs, "doc_id", "text", lex))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert small == big and len(small) == docs.count()


def test_lexicon_multiplicity_and_misses(spark):
    docs = spark.createDataFrame([(1, "Happy happy SAD"), (2, "nothing here"), (3, None)], "doc_id int, text string")
    lex = spark.createDataFrame([("happy", 0.9, 0.5), ("sad", 0.3, 0.2)], "word string, valence double, arousal double")
    got = {r.doc_id: (r.lex_valence, r.lex_hits) for r in lexicon_scores(docs, "doc_id", "text", lex).collect()}
    assert abs(got[1][0] - (0.9 + 0.9 + 0.3) / 3) < 1e-12 and got[1][1] == 3
    assert got[2] == (None, 0) and got[3] == (None, 0)


def test_cache_wins_only_with_both_values(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lex = benchmark_lexicon(spark, SF)
    cache = docs.where(F.col("lang") == "en").select(
        "doc_id", F.lit("0.5").alias("cached_valence"),
        F.when(F.col("doc_id") % 2 == 0, F.lit(0.25)).alias("cached_arousal"))
    scores = docs.select("doc_id", F.lit(0.0).alias("p1"), F.lit(0.7).alias("p2"))
    scores = scores.union(scores)                       # a repeated side row counts once
    out = lyric_sentiment(docs.select("doc_id", "text"), "doc_id", "text", lex, scores, cache).collect()
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    assert len(out) == docs.count()
    for r in out:
        assert (r.sentiment_source == "cache") == (r.doc_id in english and r.doc_id % 2 == 0)


def test_polarity_scorer_feeds_fallback(spark):
    from cadenza.operators.sentiment import polarity_scores
    docs = spark.createDataFrame([(1, "good good bad"), (2, "meh"), (3, "bad")], "doc_id int, text string")
    pol = spark.createDataFrame([("good", 0.8), ("bad", -1.0)], "word string, polarity double")
    p = {r.doc_id: r.p1 for r in polarity_scores(docs, "doc_id", "text", pol).collect()}
    assert abs(p[1] - ((0.8 + 0.8 - 1.0) / 3 + 1) / 2) < 1e-12 and p[2] is None and p[3] == 0.0
    empty_lex = spark.createDataFrame([], "word string, valence double, arousal double")
    scores = polarity_scores(docs, "doc_id", "text", pol).withColumn("p2", F.lit(0.6))
    out = {r.doc_id: (r.lyric_valence, r.sentiment_source)
           for r in lyric_sentiment(docs, "doc_id", "text", empty_lex, scores=scores).collect()}
    assert out[3] == (0.6, "scorer2")        # scorer 1 gave exactly 0.0: falls through
    assert out[2] == (0.6, "scorer2") and out[1][1] == "scorer1"


def test_common_words_take_no_shuffle_by_document_and_word(spark):
    docs = spark.createDataFrame([(1, "aa aa bb rare"), (1, "aa cc"), (2, "bb bb zz Aa once"), (None, "aa dd"), (3, ""), (4, None), (5, "zz zz zz")],
                                 "doc_id int, text string").withColumn("n", F.coalesce("doc_id", F.lit(0)) * 10)
    lex = spark.createDataFrame([("aa", 0.5, 0.25), ("bb", 1.0, None), ("rare", 0.0, 1.0), ("dd", None, 0.75), ("unused", 1.0, 1.0)],
                                "word string, valence double, arousal double")
    joined = lexicon_scores(docs, "doc_id", "text", lex, carry=["n"], shuffled=True)
    want = {1: (0.5, 0.4375, 5, 10), 2: (round(2.5 / 3, 9), 0.25, 3, 20), None: (0.5, 0.5, 1, 0), 3: (None, None, 0, 30), 4: (None, None, 0, 40), 5: (None, None, 0, 50)}
    assert _collect(joined) == {k: (k, *v) for k, v in want.items()}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning(_id" not in plan


def test_common_words_are_the_most_frequent(spark):
    from cadenza.operators.sentiment import common_words
    words = spark.createDataFrame([(w,) for w, n in (("a", 9), ("b", 8), ("c", 4), ("d", 2), ("e", 1), ("x" * 65, 30)) for _ in range(n)], "word string")
    found = {most: {r.word for r in common_words(words, most).collect()} for most in (9, 3, 2, 1)}
    assert found == {9: {"a", "b", "c", "d"}, 3: {"a", "b", "c"}, 2: {"a", "b"}, 1: set()}
