"""Gate (PRJ-*), merge back (WIN-1/JOI-1), resolve (JOI-2..5), upsert (JOI-13)."""

from pyspark.sql import functions as F

from cadenza.operators.gate import gate_tracks, missing_counts, split_ready
from cadenza.operators.merge import first_per_key, merge_back
from cadenza.operators.resolve import (failed_ids, features_with_fallback, known_ids,
                                       resolve_tracks, upsert_cache)

GATE_DDL = ("id int, track_id string, source_link string, bpm string, mode string, "
            "lyric_valence string, lyric_arousal string, title string, artist string")


def test_gate_rules(spark):
    df = spark.createDataFrame([
        (1, " ", "l", "120", "Major", "0.4", None, "t", "a"),      # blank id: READY, listed
        (2, "x", "l", "0", "Minor", "0", "0", "t", "a"),           # valence 0 -> NULL: HOLD
        (3, "x", None, "abc", None, "0.3", "0.2", "t", "a"),       # several missing
    ], GATE_DDL)
    g = {r.id: r for r in gate_tracks(df, "2024-01-01").collect()}
    assert g[1].required_ok and g[1].missing == "Track ID" and g[1].ready_to_score == "READY"
    assert g[1].lyric_arousal is None
    assert g[2].bpm == 0.0 and g[2].lyric_valence is None and g[2].lyric_arousal is None
    assert not g[2].required_ok and g[2].missing == "Lyric sentiment valence"
    assert g[3].missing == "Source Link, BPM, Mode" and g[3].ready_to_score == "HOLD"
    assert g[1].bpm_source == "spotify/analysis" and g[3].bpm_source is None
    assert g[1].date_added == "2024-01-01"
    ready, needs = split_ready(gate_tracks(df, "2024-01-01"))
    assert ready.count() + needs.count() == 3 and ready.count() == 1
    mc = missing_counts(gate_tracks(df, "2024-01-01")).collect()[0]
    assert (mc.n_rows, mc.missing_bpm, mc.missing_mode, mc.n_ready, mc.n_hold) == (3, 1, 1, 1, 2)


def test_gate_overlay_and_mojibake(spark):
    df = spark.createDataFrame([(1, "BeyoncÃ©", "x", " ", "New Artist")],
                               "id int, title string, artist string, title_new string, artist_new string")
    r = gate_tracks(df, "2024-01-01").collect()[0]
    assert r.title == "Beyoncé" and r.artist == "New Artist"


def test_merge_back(spark):
    orig = spark.createDataFrame([(0, "Song", "Art"), (1, "Other", None), (2, "Missing", "x")],
                                 "_row long, title string, artist string")
    final = spark.createDataFrame([(5, " song ", "ART", "late"), (3, "SONG", "art", "first"),
                                   (4, "other", None, "nullkey")],
                                  "_row long, title string, artist string, note string")
    out = {r._row: r for r in merge_back(orig, final, run_date="2024-01-01").collect()}
    assert len(out) == 3
    assert out[0].note == "first" and out[0].title_new == "SONG" and out[0].title == "Song"
    assert out[1].note == "nullkey"           # NULL artist matches NULL artist
    assert out[2].note is None                # unmatched left row kept
    assert out[0].curator == "You" and out[0].date_added == "2024-01-01"


def test_first_per_key_skew_safe(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"),
                                     (F.col("id") * 3).alias("v"))
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], "o").collect())
    assert got == [(0, 0, 0), (1, 1, 3)]
    last = sorted(tuple(r) for r in first_per_key(df, ["k"], "o", last=True).collect())
    assert last == [(0, 4998, 14994), (1, 4999, 14997)]


def test_resolve_and_not_found(spark):
    songs = spark.createDataFrame([(1, " Song ", "Art"), (2, "Nope", "X"), (3, "", "Y"), (4, None, "Z")],
                                  "sid int, title string, artist string")
    catalog = spark.createDataFrame(
        [("t1", ("u1",), "song", [("art",), ("b",)], 2.0), ("t2", ("u2",), "SONG", [("Art",)], 1.0)],
        "id string, external_urls struct<spotify string>, name string, "
        "artists array<struct<name string>>, rank double")
    hits, missing = resolve_tracks(songs, catalog, [F.col("rank")])
    h = hits.collect()
    assert len(h) == 1 and h[0].track_id == "t2" and h[0].found_artists == "Art" and h[0].title == "Song"
    assert [r.line for r in missing.collect()] == ["Nope - X"]


def test_features_fallback(spark):
    hits = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "track_id string")
    feats = spark.createDataFrame([("a", None, 1, .5), ("d", None, None, None)],
                                  "track_id string, tempo double, mode int, valence double")
    ana = spark.createDataFrame([("a", (99.0, 0)), ("b", (90.0, 0))],
                                "track_id string, track struct<tempo double, mode int>")
    out = {r.track_id: r for r in features_with_fallback(hits, feats, ana).collect()}
    assert out["a"].bpm is None and out["a"].mode == "Major" and out["a"].valence == .5
    assert out["b"].bpm == 90.0 and out["b"].mode == "Minor" and out["b"].valence is None
    assert out["c"].features_source is None
    assert [r.track_id for r in failed_ids(hits, feats, ana).collect()] == ["c"]
    ids = spark.createDataFrame([("a",), ("zz",)], "track_id string")
    k = {r.track_id: r.found for r in known_ids(ids, feats).collect()}
    assert k == {"a": True, "zz": False}


def test_upsert_cache(spark):
    old = spark.createDataFrame([("k1", 1.0, "Major"), ("k2", 2.0, "Minor")], "song_key string, bpm double, mode string")
    new = spark.createDataFrame([("k2", 5.0, None, 1), ("k2", 6.0, "Major", 2), ("k3", None, None, 3)],
                                "song_key string, bpm double, mode string, _row long")
    got = {r.song_key: (r.bpm, r.mode, r.origin) for r in upsert_cache(old, new, "song_key", "_row").collect()}
    assert got == {"k1": (1.0, "Major", "old"), "k2": (6.0, "Major", "new"), "k3": (None, None, "new")}
