"""Operator tables for string/key functions (PRJ-2, FN-S1..S13)."""

from pyspark.sql import functions as F

from cadenza import config as C
from cadenza.functions import text


def _apply(spark, values, fn, ddl="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col(df.columns[1]))).collect()]


def test_is_missing(spark):
    got = _apply(spark, [None, "", " ", " ", "x", "0"], text.is_missing)
    assert got == [True, True, True, True, False, False]


def test_strip_unicode(spark):
    assert _apply(spark, ["  a b \t", "\x1cx\x1f"], text.strip) == ["a b", "x"]


def test_enrich_key(spark):
    titles = ["Song (feat. X)", "Song - Remastered 2011", "Song - Live at Y", "Well-Lived Day", "A   B"]
    df = spark.createDataFrame([(i, t, "Art") for i, t in enumerate(titles)], "i int, t string, a string")
    got = [r[0] for r in df.orderBy("i").select(text.enrich_key("t", "a")).collect()]
    assert got == ["song|||art", "song|||art", "song|||art", "well|||art", "a b|||art"]
    nul = spark.createDataFrame([(None, "a")], "t string, a string").select(text.enrich_key("t", "a"))
    assert nul.collect()[0][0] is None


def test_other_keys(spark):
    df = spark.createDataFrame([(" Song (x) ", " ART ")], "t string, a string")
    r = df.select(text.lyrics_key("t", "a"), text.answer_key("t", "a"),
                  text.merge_norm("t"), text.merge_norm(F.lit(None).cast("string"))).collect()[0]
    assert tuple(r) == ("song (x)|||art", "Song (x)|||ART", "song (x)", None)


def test_fix_mojibake(spark):
    src = ["BeyoncÃ©", "donâ€™t", "Ângela", "plain", "é", None]
    want = ["Beyoncé", "dont", "ngela", "plain", "é", None]
    assert _apply(spark, src, text.fix_mojibake) == want
    twice = "Ã\u0083Â©"
    assert _apply(spark, [twice], lambda c: text.fix_mojibake(text.fix_mojibake(c))) == ["é"]


def test_corrupt_then_fix_round_trip(spark):
    src = ["café crème", "naïve", "ascii"]
    got = _apply(spark, src, lambda c: text.fix_mojibake(text.corrupt_latin1(c)))
    assert got == src


def test_clean_lyrics_fetch(spark):
    src = ["a\nEmbedded x\nb", "[Chorus] la", "keep\nYou might also like more\nend", None]
    got = _apply(spark, src, text.clean_lyrics_fetch)
    assert got == ["a b", "la", "keep end", ""]


def test_clean_lyrics_gate(spark):
    src = ["la 12 Contributors rest", "la Read More rest", "a Page 1 Page 2 b", None]
    assert _apply(spark, src, text.clean_lyrics_gate) == ["la", "la", "a  b", None]


def test_tokens(spark):
    assert _apply(spark, ["Don't STOP étude", None], text.tokens) == [["don't", "stop", "tude"], []]


def test_word_count(spark):
    assert _apply(spark, ["", "  a  b c ", None], text.word_count) == [0, 3, None]


def test_lyric_status(spark):
    words24 = " ".join(["la"] * 24)
    words25 = " ".join(["la"] * 25)
    words30 = " ".join(["la"] * 28)
    src = [None, " ", "soft piano night", words24, words25, words30 + " this song",
           words30 + " instrumentals here"]
    got = _apply(spark, src, text.lyric_status)
    assert got == ["MISSING", "MISSING", "INSTRUMENTAL", "SHORT", "GOOD", "SUMMARY", "SUMMARY"]


def test_lyric_status_config(spark):
    cfg = C.LyricStatusConfig(short_words=2, instrumental_words=("zz",), summary_keywords=("qq",))
    got = _apply(spark, ["a zz b", "a b", "a qq c", "a"], lambda c: text.lyric_status(c, cfg))
    assert got == ["INSTRUMENTAL", "GOOD", "SUMMARY", "SHORT"]


def test_fmt2_and_prompt(spark):
    assert _apply(spark, [0.12, 0.5, 0.126, None], text.fmt2_or_na, "x double") == ["0.12", "0.50", "0.13", "NA"]
    df = spark.createDataFrame([(" T ", "A", 120.0, None, None, 0.5, None)],
                               "t string, a string, b double, m string, s double, v double, r double")
    p = df.select(text.prompt_text("t", "a", "b", "m", "s", "v", "r")).collect()[0][0]
    assert "Song: T — A" in p and "- BPM: 120.0" in p and "- Mode: NA" in p
    assert "- Lyric valence: 0.50" in p and "- Lyric arousal: NA" in p


def test_join_names(spark):
    df = spark.createDataFrame([([("a",), ("b",)],)], "arts array<struct<name string>>")
    assert df.select(text.join_names("arts")).collect()[0][0] == "a, b"
