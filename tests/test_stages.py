"""End to end over the stage API on literal rows (the original's script order)."""

from pyspark.sql import functions as F

from cadenza import stages

PROV_DDL = ("song_key string, p1_bpm double, p2_bpm double, p2_mode string, p3_bpm double, "
            "p3_mode string, p4_bpm double, p4_mode string")


def test_stages_end_to_end(spark):
    songs = spark.createDataFrame([(0, "Clair de Lune", "Debussy"), (1, "Gnossienne", "Satie"),
                                   (2, "Missing Song", "Nobody"), (3, "clair de lune ", "DEBUSSY")],
                                  "_row long, title string, artist string")
    catalog = spark.createDataFrame(
        [("t1", ("u1",), "Clair de Lune", [("Debussy",)], 1), ("t2", ("u2",), "Gnossienne", [("Satie",)], 1)],
        "id string, external_urls struct<spotify string>, name string, artists array<struct<name string>>, rank int")
    features = spark.createDataFrame([("t1", None, 1, 0.4)], "track_id string, tempo double, mode int, valence double")
    analysis = spark.createDataFrame([("t2", (66.0, 0))], "track_id string, track struct<tempo double, mode int>")
    r = stages.resolve_stage(songs, catalog, [F.col("rank")], features, analysis)
    assert [x.line for x in r["not_found"].collect()] == ["Missing Song - Nobody"]
    tracks = r["tracks"]
    assert tracks.count() == 3

    providers = spark.createDataFrame([("clair de lune|||debussy", 70.0, None, None, None, None, None, None)],
                                      PROV_DDL)
    enriched, cache = stages.enrich_stage(tracks, providers)
    e = {x._row: (x.bpm, x.mode, x.bpm_source) for x in enriched.collect()}
    assert e[0] == (70.0, "Major", "Deezer(bpm)")       # tempo from provider 1
    assert e[3] == (70.0, "Major", "cache")             # same key: early return on cached bpm + own mode
    assert e[1] == (66.0, "Minor", None)
    assert cache.count() == 2

    lexicon = spark.createDataFrame([("moon", 0.7, 0.2), ("night", 0.4, 0.3)], "word string, valence double, arousal double")
    source = spark.createDataFrame([("clair de lune|||debussy", "Moon night\nEmbed 12\nmoon"),
                                    ("gnossienne|||satie", "")], "lyrics_key string, lyrics string")
    lyr = stages.lyrics_stage(enriched, lexicon, lyrics_source=source)
    lv = {x._row: (x.lyrics, round(x.lyric_valence, 6) if x.lyric_valence is not None else None)
          for x in lyr.collect()}
    assert lv[0] == ("Moon night moon", 0.6) and lv[1] == ("", None)

    answers = spark.createDataFrame([], "answer_key string, listening_context string, contraindications string, rationale string")
    ctx = stages.context_stage(lyr, answers)
    assert ctx["tracks"].where(F.col("listening_context").isNull()).count() == 0
    assert ctx["updates"].collect()[0].updated_rows == 3 and ctx["failures"].count() == 0
    # a second run over its own output: nothing to do, nothing changes
    again = stages.context_stage(ctx["tracks"], ctx["answers"].drop("answer_source"))
    assert again["updates"].collect()[0].n_rows == 0
    assert sorted(map(str, again["tracks"].collect())) == sorted(map(str, ctx["tracks"].collect()))

    g = stages.gate_stage(ctx["tracks"].withColumn("bpm", F.col("bpm").cast("string"))
                          .withColumn("lyric_valence", F.col("lyric_valence").cast("string"))
                          .withColumn("lyric_arousal", F.col("lyric_arousal").cast("string")), "2024-01-01")
    assert g["ready"].count() + g["needs"].count() == 3
    q = stages.quality_stage(g["gated"])
    assert q["counts"].agg(F.sum("n_rows")).collect()[0][0] == 3
    scored = stages.score_stage(g["gated"])
    assert sorted(x["rank"] for x in scored.collect()) == [1, 2, 3]
    merged = stages.merge_stage(songs, lyr.select("_row", "title", "artist", "lyrics"), "2024-01-01")
    assert merged.count() == 4


def test_lyrics_cache_snapshot(spark):
    tracks = spark.createDataFrame([(0, "A", "X", "la", 0.5, None), (1, " a ", "x", "la la", 0.6, 0.2),
                                    (2, "B", "Y", "", None, None)],
                                   "_row long, title string, artist string, lyrics string, "
                                   "lyric_valence double, lyric_arousal double")
    old = spark.createDataFrame([("c|||z", "old", 0.1, 0.1), ("a|||x", "stale", 0.9, 0.9)],
                                "lyrics_key string, lyrics string, valence double, arousal double")
    snap = {r.lyrics_key: (r.lyrics, r.valence, r.arousal, r.origin)
            for r in stages.lyrics_cache_snapshot(tracks, old).collect()}
    assert snap == {"a|||x": ("la la", 0.6, 0.2, "new"), "b|||y": ("", None, None, "new"),
                    "c|||z": ("old", 0.1, 0.1, "old")}


def test_context_stage_overwrites_answered_rows_only(spark):
    tracks = spark.createDataFrame(
        [(0, "A", "X", "kept", "kept"), (1, "B", "X", "half", None), (2, "C", "X", None, "old"), (3, " ", "X", None, "blank")],
        "_row long, title string, artist string, listening_context string, contraindications string")
    answers = spark.createDataFrame([("B|||X", "new", None, "r")], "answer_key string, listening_context string, contraindications string, rationale string")

    def refuses(batches):
        for pdf in batches:
            raise RuntimeError("no " + "x" * 900)
            yield pdf
    ctx = stages.context_stage(tracks, answers, model=refuses)
    got = {r._row: (r.listening_context, r.contraindications) for r in ctx["tracks"].collect()}
    assert got == {0: ("kept", "kept"), 1: ("new", None), 2: (None, "old"), 3: (None, "blank")}
    failed = ctx["failures"].collect()
    assert [r.answer_key for r in failed] == ["C|||X"] and failed[0].error == "RuntimeError: no " + "x" * 900
    assert ctx["answers"].count() == 1                    # a failure is no cache entry
    assert ctx["updates"].collect()[0].updated_rows == 1


def test_side_tables_with_repeated_keys_do_not_multiply_rows(spark):
    tracks = spark.createDataFrame([(0, "A", "X"), (1, "B", "Y")], "_row long, title string, artist string")
    lexicon = spark.createDataFrame([("la", 0.5, 0.5)], "word string, valence double, arousal double")
    source = spark.createDataFrame([("a|||x", "la one"), ("a|||x", "la two")], "lyrics_key string, lyrics string")
    cache = spark.createDataFrame([("b|||y", 0.1, 0.2), ("b|||y", 0.3, 0.4)], "lyrics_key string, cached_valence double, cached_arousal double")
    out = stages.lyrics_stage(tracks, lexicon, lyrics_source=source, sentiment_cache=cache).collect()
    assert sorted((r._row, r.lyrics, r.lyric_valence) for r in out) == [(0, "la one", 0.5), (1, "", 0.1)]


def test_hits_are_not_multiplied_by_repeated_features(spark):
    from cadenza.operators.resolve import features_with_fallback
    hits = spark.createDataFrame([("t1",), ("t2",), ("t3",), (None,)], "track_id string")
    feats = spark.createDataFrame([("t1", 90.0, 1, 0.5, 2), ("t1", 80.0, 0, 0.4, 1), (None, 1.0, 1, 1.0, 3)],
                                  "track_id string, tempo double, mode int, valence double, o int")
    ana = spark.createDataFrame([("t2", (70.0, 1)), ("t2", (60.0, 0))], "track_id string, track struct<tempo double, mode int>")
    got = sorted(((r.track_id, r.bpm, r.mode) for r in features_with_fallback(hits, feats, ana, features_order="o").collect()), key=str)
    assert got == sorted([("t1", 80.0, "Minor"), ("t2", 60.0, "Minor"), ("t3", None, None), (None, None, None)], key=str)
