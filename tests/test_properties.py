"""Properties from the test plan on driver data."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from cadenza.functions import text
from cadenza.operators.score import score_tracks
from cadenza.plans.scoring import track_view

SF = "/root/testdata/sf0.01"


def test_scores_bounded_and_weights_normalised(spark):
    s = score_tracks(track_view(spark, SF))
    agg = s.agg(
        F.min("total_score").alias("lo"), F.max("total_score").alias("hi"),
        F.max(F.abs(F.col("bpm_weight") + F.col("mode_weight") + F.col("lyricval_weight")
                    + F.col("lyricaro_weight") - F.lit(1.0))).alias("werr")).collect()[0]
    assert 0.0 <= agg.lo <= agg.hi <= 1.0 and agg.werr < 1e-12


def test_fetch_cleaner_idempotent(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    once = text.clean_lyrics_fetch("text", ("avec", "with the"))
    df = conv.select(once.alias("a")).select("a", text.clean_lyrics_fetch("a", ("avec", "with the")).alias("b"))
    assert df.where(F.col("a") != F.col("b")).count() == 0


@settings(max_examples=40, deadline=None, database=None, derandomize=True)
@given(st.text(alphabet="ab [] \t\u00a0X", max_size=30))
def test_fetch_cleaner_idempotent_random(spark, s):
    df = spark.createDataFrame([(s,)], "t string")
    a = df.select(text.clean_lyrics_fetch("t", ("x",)).alias("a"))
    b = a.select(text.clean_lyrics_fetch("a", ("x",)).alias("b"))
    assert a.collect()[0][0] == b.collect()[0][0]


def test_merge_keeps_left_rows_and_split_is_complete(spark):
    q = entry_mod.queries()
    part_n = spark.read.parquet(f"{SF}/part.parquet").count()
    assert q["merge_back"](spark, SF).count() == part_n
    ready = q["ready_rows"](spark, SF).select("p_partkey")
    needs = q["needs_rows"](spark, SF).select("p_partkey")
    assert ready.count() + needs.count() == part_n
    assert ready.intersect(needs).count() == 0


def test_independent_of_shuffle_partitions(spark):
    q = entry_mod.queries()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = {}
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out[n] = sorted(tuple(r) for r in q["rank_tracks"](spark, SF).collect())
            out[n + "f"] = sorted(tuple(r) for r in q["enrich_fold"](spark, SF).collect())
        assert out["3"] == out["13"] and out["3f"] == out["13f"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
