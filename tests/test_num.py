"""Operator tables for numeric, mode and scoring functions (NUM-*, AGG-5/6)."""

import math

import pytest
from pyspark.sql import functions as F

from cadenza.functions import num
from cadenza.operators.score import score_tracks
from conftest import one_col, rows


def _apply(spark, values, ddl, fn):
    df = one_col(spark, values, ddl).withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in df.orderBy("_i").select(fn(F.col(df.columns[0]))).collect()]


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, abs_tol=1e-12)


def test_bpm_score(spark):
    xs = [50.0, 55.0, 60.0, 80.0, 90.0, 95.0, 100.0, 120.0, 125.0, 130.0, 200.0, None]
    want = [0, .5, 1, 1, .8, .9, 1, 1, .5, 0, 0, None]
    got = _apply(spark, xs, "x double", num.bpm_score)
    assert all(close(g, w) for g, w in zip(got, want)), got


def test_mode_score(spark):
    xs = ["Major", " MINOR ", "Dorian", "mixolydian", "Phrygian", "  ", None]
    want = [1.0, .4, .5, .8, .3, .3, None]
    assert _apply(spark, xs, "x string", num.mode_score) == want


def test_valence_arousal_scores(spark):
    v = _apply(spark, [-.5, -.15, .2, .6, .8, 1.0], "x double", num.valence_score)
    assert all(close(g, w) for g, w in zip(v, [0, .5, 1, 1, .5, 0])), v
    a = _apply(spark, [-.3, -.05, .2, .6, .8, 1.0], "x double", num.arousal_score)
    assert all(close(g, w) for g, w in zip(a, [0, .5, 1, 1, .5, 0])), a


def test_evidence_multiplier(spark):
    got = _apply(spark, ["RCT", " meta ", "unknown", None], "x string", num.evidence_multiplier)
    assert got == [1.15, 1.10, 1.0, 1.0]


@pytest.mark.parametrize("score,grade", [
    (.9701, "A+"), (.9699, "A"), (.9301, "A"), (.9001, "A-"), (.8701, "B+"), (.8301, "B"),
    (.8001, "B-"), (.7701, "C+"), (.7301, "C"), (.7001, "C-"), (.6999, "D"), (.6001, "D"),
    (.5999, "F"), (0.0, "F"), (-0.1, "F"), (None, "N/A")])
def test_letter_grade(spark, score, grade):
    assert _apply(spark, [score], "x double", num.letter_grade) == [grade]


def test_total_score_renormalises(spark):
    df = spark.createDataFrame(
        [(1, 110.0, "Major", .4, .4), (2, 110.0, "Major", None, .4), (3, None, None, None, None)],
        "id int, bpm double, mode string, lyric_valence double, lyric_arousal double")
    out = {r["id"]: r for r in score_tracks(df).collect()}
    w = out[1]
    assert close(w.bpm_weight + w.mode_weight + w.lyricval_weight + w.lyricaro_weight, 1.0)
    assert close(out[1].total_score, 1.0)
    # valence missing: renormalised over the three present features
    assert close(out[2].total_score, 1.0)
    assert out[3].total_score is None and out[3].letter_grade == "N/A"
    # default evidence applied
    assert out[1].bpm_evidence == "meta" and out[1].mode_evidence == "theoretical"


def test_mode_from_key_string(spark):
    xs = ["C major", "A Minor", "G#m", "C", "C#", "Am ", "", None]
    want = ["Major", "Minor", "Minor", None, None, None, None, None]
    assert _apply(spark, xs, "x string", num.mode_from_key_string) == want


def test_mode_from_scale(spark):
    assert _apply(spark, [" Major ", "minor", "dorian", None], "x string",
                  num.mode_from_scale_text) == ["Major", "Minor", None, None]
    assert _apply(spark, [1.0, 0.0, 1.9, -0.5, 2.0], "x double",
                  num.mode_from_scale_number) == ["Major", "Minor", "Major", "Minor", None]


def test_coerce_number(spark):
    xs = ["120", " 1.5 ", "1e3", "1.5d", "1_0", "abc", "nan", "inf", None]
    want = [120.0, 1.5, 1000.0, None, None, None, None, None, None]
    assert _apply(spark, xs, "x string", num.coerce_number) == want


def test_sentiment_fallback(spark):
    df = spark.createDataFrame([(.4, .9, None), (None, 0.0, .7), (None, .3, .7), (None, None, None)],
                               "lex double, p1 double, p2 double")
    got = [r[0] for r in df.select(num.sentiment_fallback("lex", "p1", "p2")).collect()]
    assert got == [.4, .7, .3, None]


def test_sanitize_and_zero(spark):
    got = _apply(spark, [float("nan"), float("inf"), float("-inf"), 2.0], "x double", num.sanitize)
    assert got == [None, None, None, 2.0]
    assert _apply(spark, [0.0, 5.0], "x double", num.zero_to_null) == [None, 5.0]
    assert _apply(spark, [0.0, 5.0], "x double", num.positive_or_null) == [None, 5.0]


def test_mode_from_int(spark):
    assert _apply(spark, [1, 0, 2, None], "x int", num.mode_from_int) == ["Major", "Minor", None, None]


def test_rows_helper(spark):
    assert rows(spark.createDataFrame([(1,)], "a int")) == [(1,)]
