"""Sources/sinks (SRC-*, SNK-*), frames (AGG-8..11), clips (INF-3, SRC-8),
answers (FN-P7, INF-2, PRJ-14) and the incremental stream (STR-1)."""

import json
import os

import pyspark.sql.functions as F

from cadenza.operators.answers import infer_answers, lookup_answers, parse_answer, work_set
from cadenza.operators.clips import analyse_clips
from cadenza.operators.frames import chroma_mode, median_tempo, mono_mix, top_candidate
from cadenza.sources import io
from cadenza.streaming.incremental import cache_as_of, merge_runs, run_incremental_enrich, runs_as_of

PROV_DDL = ("song_key string, p1_bpm double, p2_bpm double, p2_mode string, p3_bpm double, "
            "p3_mode string, p4_bpm double, p4_mode string")


def test_csv_quotes_newlines_na(spark, tmp_dir):
    p = os.path.join(tmp_dir, "songs.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('Title,Artist,Lyrics\n"The Four Seasons: ""Spring""",Vivaldi,"line one\nline two"\nNA,,x\n')
    df = io.read_csv(spark, p, "Title string, Artist string, Lyrics string")
    rows = sorted(df.collect(), key=lambda r: r._row)
    assert len(rows) == 2
    assert rows[0].Title == 'The Four Seasons: "Spring"' and rows[0].Lyrics == "line one\nline two"
    assert rows[1].Title == "NA" and rows[1].Artist is None


def test_cache_json_import(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cache.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump({"a|||b": {"BPM": 90.5, "Mode": "Major"}, "c|||d": {"BPM": None, "Mode": None}}, f, indent=2)
    got = {r.song_key: (r.BPM, r.Mode) for r in io.import_cache_document(spark, p).collect()}
    assert got == {"a|||b": (90.5, "Major"), "c|||d": (None, None)}
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as f:
        f.write("{not json")
    assert io.import_cache_document(spark, bad).count() == 0
    assert io.import_cache_document(spark, os.path.join(tmp_dir, "absent.json")).count() == 0


def test_lexicon_scan(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lex.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("# comment\n\nHappy\t0.9\t0.7\nsad 0.1\nword x y\nhappy 0.8 0.6\n  Calm  0.5   0.2  \n")
    got = {r.word: (r.valence, r.arousal) for r in io.read_lexicon(spark, p).collect()}
    assert got == {"happy": (0.8, 0.6), "calm": (0.5, 0.2)}


def test_count_listed_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ids.txt")
    with open(p, "w") as f:
        f.write("\n\n  \nid1\n\nid2\n\n\n")
    assert io.count_listed_lines(spark, p).collect()[0][0] == 3
    e = os.path.join(tmp_dir, "empty.txt")
    open(e, "w").close()
    assert io.count_listed_lines(spark, e).collect()[0][0] == 0


def test_clip_size_gate(spark, tmp_dir):
    d = os.path.join(tmp_dir, "clips")
    os.makedirs(d)
    for name, n in (("a.bin", 4999), ("b.bin", 5000), ("c.bin", 0)):
        with open(os.path.join(d, name), "wb") as f:
            f.write(bytes(range(256)) * (n // 256) + bytes(n % 256))
    kept = [os.path.basename(r.path) for r in io.read_clips(spark, d, 5000).collect()]
    assert kept == ["b.bin"]


def test_snapshots_and_export(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    df = spark.createDataFrame([("k", float("nan"), "Major"), ("j", float("inf"), None), ("i", -1.0 * float("inf"), None)],
                               "song_key string, bpm double, mode string")
    io.write_snapshot(df, base)
    io.write_snapshot(df.limit(1), base)
    assert io.snapshot_versions(spark, base) == [1, 2]
    latest = io.read_snapshot(spark, base)
    assert latest.count() == 1
    v1 = spark.read.parquet(base + "/v=1")
    assert all(r.bpm is None for r in v1.collect())
    out = os.path.join(tmp_dir, "export")
    io.export_cache_json_lines(v1, "song_key", out)
    back = {r.song_key: (r.bpm, r.mode) for r in io.read_cache_json_lines(spark, out, "bpm double, mode string").collect()}
    assert back == {"k": (None, "Major"), "j": (None, None), "i": (None, None)}       # every key of every line
    assert io.read_cache_json_lines(spark, out + "-none").count() == 0
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert '{"k":{"bpm":null,"mode":"Major"}}' in lines


def test_split_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, "READY", True), (2, "HOLD", False), (3, "HOLD", False)],
                               "id int, ready_to_score string, required_ok boolean")
    out = os.path.join(tmp_dir, "split")
    counts = io.write_split(df, out)
    assert counts == {"n_rows": 3, "n_ready": 1, "n_hold": 2}
    assert spark.read.parquet(out + "/ready_to_score=HOLD").count() == 2
    assert io.write_lines_if_any(df.where("id > 5"), "id", os.path.join(tmp_dir, "none")) is False


def test_frames(spark):
    f = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 1.0), ("b", 4.0)], "t string, tempo double")
    assert {r.t: r.median_tempo for r in median_tempo(f, "t").collect()} == {"a": 2.0, "b": 2.5}
    c = spark.createDataFrame([("a", 1, 100.0, .5), ("a", 0, 120.0, .5), ("a", 2, 90.0, .4)],
                              "t string, pos int, bpm double, weight double")
    assert top_candidate(c, "t").collect()[0].top_tempo == 120.0
    chroma = [0.0] * 12
    tie = spark.createDataFrame([("a", chroma)], "t string, chroma array<float>")
    assert chroma_mode(tie, "t").collect()[0]["mode"] == "Major"
    m = spark.createDataFrame([([1.0, 3.0],), ([],)], "ch array<double>")
    assert [r[0] for r in m.select(mono_mix(F.col("ch"))).collect()] == [2.0, None]


def test_clip_analysis_prefers_analyser(spark):
    def lengths(batches):
        """An analyser hook: two frames whose tempo is the clip's length, all of it."""
        import pandas as pd
        for pdf in batches:
            n = [len(c) for c in pdf["content"]]
            yield pd.DataFrame({"clip_id": [c for c in pdf["clip_id"] for _ in "ab"], "frame": [0, 1] * len(n),
                                "tempo": [float(x) for x in n for _ in "ab"], "chroma": [[1.0] + [0.0] * 11] * (2 * len(n))})
    clips = spark.createDataFrame([("big", b"x" * 6001), ("small", b"x" * 10), ("lost", b"")], "clip_id string, content binary")
    fb = spark.createDataFrame([("small", 88.0, "Minor")], "clip_id string, bpm double, mode string")
    got = {r.clip_id: r for r in analyse_clips(clips, lengths, fallback=fb).collect()}
    assert got["big"].bpm_source == "analyser" and got["big"].bpm == 6001.0 and got["big"]["mode"] == "Major"
    assert got["small"].bpm == 88.0 and got["small"].bpm_source == "fallback"
    assert got["lost"].bpm is None and got["lost"]["mode"] is None and len(got) == 3     # a small clip keeps its row


def test_answers(spark):
    raw = spark.createDataFrame([("k1", '{"listening_context": "a", "contraindications": "b", "rationale": "c"}'),
                                 ("k2", '{"listening_context": '), ("k3", "[1, 2]")], "answer_key string, raw string")
    parsed = {r.answer_key: r for r in raw.select("answer_key", *parse_answer("raw")).collect()}
    assert parsed["k1"].parse_ok and parsed["k1"].listening_context == "a"
    assert not parsed["k2"].parse_ok and parsed["k2"].listening_context is None
    assert not parsed["k3"].parse_ok
    tracks = spark.createDataFrame([(1, "k1"), (2, "K1")], "id int, answer_key string")
    looked = {r.id: r.needs_inference for r in lookup_answers(tracks, raw.select(
        "answer_key", *parse_answer("raw"))).collect()}
    assert looked == {1: False, 2: True}               # keys are case-sensitive
    ws = spark.createDataFrame([("t", "a", "x", "y"), ("t", "a", "x", None), (" ", "a", None, None)],
                               "title string, artist string, listening_context string, contraindications string")
    assert work_set(ws).count() == 1                    # both filled: skipped; blank title: skipped


def test_infer_answers_only_new_keys(spark):
    tracks = spark.createDataFrame([(1, "a", -0.2, 0.1), (2, "a", 0.5, 0.1), (3, "b", 0.5, 0.9), (4, "c", 0.1, 0.1)],
                                   "_row long, answer_key string, lyric_valence double, lyric_arousal double")
    cached = spark.createDataFrame([("c", "ctx", "con", "why")],
                                   "answer_key string, listening_context string, contraindications string, rationale string")
    filled, snap, failures = infer_answers(tracks, cached, "_row")
    assert failures.count() == 0
    got = {r._row: (r.answer_source, r.rationale) for r in filled.collect()}
    assert got[1] == ("model", "lval=-0.20 laro=0.10") and got[2] == got[1]   # first row of the key decides
    assert got[4] == ("cache", "why")
    assert snap.where("answer_source = 'model'").count() == 2
    # second run against the new snapshot: nothing left for the model
    again, snap2, _ = infer_answers(filled, snap.drop("answer_source"), "_row")
    assert snap2.where("answer_source = 'model'").count() == 0


def test_incremental_enrich_is_resumable(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    spark.createDataFrame([(1, "k", None, None), (2, "k", 100.0, None)],
                          "_row long, song_key string, bpm double, mode string").write.parquet(land + "/f1")
    schema = spark.read.parquet(land + "/f1").schema
    prov = spark.createDataFrame([("k", None, None, "Minor", None, None, None, None)], PROV_DDL)
    work = os.path.join(tmp_dir, "work")

    def stream():
        return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(land)

    out = run_incremental_enrich(spark, stream(), lambda b: b, prov, work)
    assert out["batches"] == 1
    rows = {r._row: (r.bpm, r.mode) for r in spark.read.parquet(out["rows"]).collect()}
    assert rows == {1: (None, "Minor"), 2: (100.0, "Minor")}
    again = run_incremental_enrich(spark, stream(), lambda b: b, prov, work)
    assert again["batches"] == 0
    cache = cache_as_of(spark, out["cache"], 99).collect()
    # row 2 returns early (own BPM + cached mode), so the cache keeps row 1's write
    assert [(r.song_key, r.bpm, r.mode) for r in cache] == [("k", None, "Minor")]


def test_median_keeps_null_keys_and_tracks_without_tempo(spark):
    frames = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, 5.0), (None, 7.0)], "t string, tempo double")
    got = {r.t: (r.median_tempo, r.n_frames) for r in median_tempo(frames, "t").collect()}
    assert got == {"a": (2.0, 2), "b": (None, 0), None: (6.0, 2)}


def test_model_failures_are_isolated(spark):
    def flaky(batches):
        for pdf in batches:
            if (pdf["answer_key"] == "bad").any():
                raise RuntimeError("model refused")
            yield pdf.assign(raw='{"listening_context": "ok", "contraindications": "none", "rationale": "r"}')[
                ["answer_key", "raw"]]
    tracks = spark.createDataFrame([(1, "good", 0.1, 0.1), (2, "bad", 0.1, 0.1)],
                                   "_row long, answer_key string, lyric_valence double, lyric_arousal double")
    empty = spark.createDataFrame([], "answer_key string, listening_context string, contraindications string, rationale string")
    filled, snap, failures = infer_answers(tracks, empty, "_row", model=flaky)
    got = {r.answer_key: r.listening_context for r in filled.collect()}
    assert got == {"good": "ok", "bad": None}
    assert [r.answer_key for r in snap.collect()] == ["good"]
    assert [(r.answer_key, r.error, r.parse_ok) for r in failures.collect()] == [("bad", "RuntimeError: model refused", False)]


def test_model_gets_the_whole_prompt(spark):
    def echo(batches):
        for pdf in batches:
            yield pdf.assign(raw=[json.dumps({"listening_context": p, "contraindications": s, "rationale": t})
                                  for p, s, t in zip(pdf["prompt"], pdf["system"], pdf["title"])])[["answer_key", "raw"]]
    tracks = spark.createDataFrame([(1, "T|||A", " T ", "A", 96.0, "Minor", 0.123, -0.5, None)],
                                   "_row long, answer_key string, title string, artist string, bpm double, mode string, valence double, lyric_valence double, lyric_arousal double")
    empty = spark.createDataFrame([], "answer_key string, listening_context string, contraindications string, rationale string")
    r = infer_answers(tracks, empty, "_row", model=echo)[0].collect()[0]
    assert r.listening_context.startswith("Song: T — A\nAttributes:\n- BPM: 96.0\n- Mode: Minor\n- Spotify valence: 0.12\n"
                                          "- Lyric valence: -0.50\n- Lyric arousal: NA\n\nTask:\n")
    assert r.listening_context.endswith("Output strict JSON only.") and "Do not diagnose" in r.contraindications
    assert r.rationale == "T"


def test_incremental_enrich_second_file_sees_first_batch_cache(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing2")
    ddl = "_row long, song_key string, bpm double, mode string"
    spark.createDataFrame([(1, "k", 120.0, "Major")], ddl).write.parquet(land + "/f1")
    schema = spark.read.parquet(land + "/f1").schema
    prov = spark.createDataFrame([], PROV_DDL)
    work = os.path.join(tmp_dir, "work2")

    def stream():
        return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(land)

    first = run_incremental_enrich(spark, stream(), lambda b: b, prov, work)
    spark.createDataFrame([(2, "k", None, None)], ddl).write.parquet(land + "/f2")
    second = run_incremental_enrich(spark, stream(), lambda b: b, prov, work)
    assert first["batches"] == 1 and second["batches"] == 1
    rows = {r._row: (r.bpm, r.mode, r.bpm_source) for r in spark.read.parquet(second["rows"]).collect()}
    assert rows[2] == (120.0, "Major", "cache")       # filled from the first batch's snapshot
    assert io.snapshot_versions(spark, second["cache"] + "/deltas")[-1] == 2


def test_cache_versions_deltas_and_compaction(spark, tmp_dir):
    base = os.path.join(tmp_dir, "cachev")
    ddl = "song_key string, bpm double, mode string"
    for v, rows in enumerate([[("k", 1.0, None), ("j", 5.0, None)], [("k", 2.0, "Major")], [("i", 3.0, None)]]):
        io.write_snapshot(spark.createDataFrame(rows, ddl), base + "/deltas", version=v)
    at = lambda v: {r.song_key: r.bpm for r in cache_as_of(spark, base, v).collect()}
    assert at(0) == {"k": 1.0, "j": 5.0}                # a replay of batch 0 doesn't see what it wrote
    assert at(1) == {"k": 2.0, "j": 5.0} and at(2) == {"k": 2.0, "j": 5.0, "i": 3.0}
    assert merge_runs(spark, base, 7) == [f"{base}/runs/level=1/v=7"] and at(7) == at(2)
    assert at(2) == {"k": 2.0, "j": 5.0, "i": 3.0} and at(0) == {"k": 1.0, "j": 5.0}
    assert cache_as_of(spark, os.path.join(tmp_dir, "nothing"), 5).count() == 0


def test_runs_read_stay_bounded_over_many_versions(spark, tmp_dir):
    """20 versions, three of them of empty batches: few runs a read, each version as a dictionary gives it."""
    base, want, states = os.path.join(tmp_dir, "cachem"), {}, []
    for v in range(20):
        if v not in (3, 10, 11):
            new = {f"k{(v * 5 + i) % 17}": float(100 * v + i) for i in range(4)}
            io.write_snapshot(spark.createDataFrame([(k, b, None) for k, b in new.items()], "song_key string, bpm double, mode string"),
                              base + "/deltas", version=v)
            want.update(new)
        merge_runs(spark, base, v, fanout=3)
        states.append(dict(want))
        assert len(runs_as_of(spark, base, v, 3)) <= 2 * 3
    assert runs_as_of(spark, base, 19, 3) == [(2, 8), (2, 17), (0, 18), (0, 19)]
    for v in (0, 2, 3, 8, 11, 17, 19):
        got = {r.song_key: r.bpm for r in cache_as_of(spark, base, v, fanout=3).collect()}
        assert got == states[v]
    merge_runs(spark, base, 17, fanout=3)               # a replay writes the same
    assert {r.song_key: r.bpm for r in cache_as_of(spark, base, 19, fanout=3).collect()} == states[19]


def test_stream_merges_its_deltas(spark, tmp_dir):
    land, work = os.path.join(tmp_dir, "landing3"), os.path.join(tmp_dir, "work3")
    ddl = "_row long, song_key string, bpm double, mode string"
    prov = spark.createDataFrame([], PROV_DDL)
    for k in range(5):
        rows = [(2 * k, f"k{k}", 100.0 + k, "Major"), (2 * k + 1, f"k{k // 2}", None, None)]
        spark.createDataFrame(rows, ddl).write.mode("append").parquet(land)
        stream = spark.readStream.schema(ddl).parquet(land)
        out = run_incremental_enrich(spark, stream, lambda b: b, prov, work, fanout=2)
    got = {r._row: r.bpm for r in spark.read.parquet(out["rows"]).collect()}
    assert got == {2 * k: 100.0 + k for k in range(5)} | {2 * k + 1: 100.0 + k // 2 for k in range(5)}
    assert runs_as_of(spark, out["cache"], 5, 2) == [(2, 3), (1, 5)]
    assert {r.song_key: r.bpm for r in cache_as_of(spark, out["cache"], 5, fanout=2).collect()} == {f"k{k}": 100.0 + k for k in range(5)}


def test_model_called_once_per_new_key(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting(batches):
        for pdf in batches:
            calls.add(len(pdf))
            yield pdf.assign(raw='{"listening_context": "c", "contraindications": "n", "rationale": "r"}')[
                ["answer_key", "raw"]]
    tracks = spark.createDataFrame([(i, f"k{i % 5}", 0.1, 0.1) for i in range(40)],
                                   "_row long, answer_key string, lyric_valence double, lyric_arousal double")
    cached = spark.createDataFrame([("k0", "x", "y", "z")],
                                   "answer_key string, listening_context string, contraindications string, rationale string")
    filled, snap, _ = infer_answers(tracks, cached, "_row", model=counting)
    filled.collect()
    snap.collect()
    filled.count()
    assert calls.value == 4          # k1..k4, each once, however often the results are used
