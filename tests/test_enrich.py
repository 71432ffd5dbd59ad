"""Provider payloads (FN-P*), chain (JOI-6/7), fold (JOI-8) with a brute-force
reference, provider pivot (AGG-7)."""

import random


from cadenza import config as C
from cadenza.functions import payload as P
from cadenza.operators.enrich import enrich_chain, enrich_fold, parse_providers, provider_pivot

PROV_DDL = ("song_key string, p1_bpm double, p2_bpm double, p2_mode string, p3_bpm double, "
            "p3_mode string, p4_bpm double, p4_mode string")


def test_payload_shapes(spark):
    rows = [('{"data":[{"bpm":120.5,"preview":"u"}]}',), ('{"data":[]}',), ('{"data":[{"bpm":0}]}',),
            ('not json',), ('{"search":[{"tempo":0,"bpm":"99","key":"C major"}]}',),
            ('{"search":[],"result":[{"tempo":"fast","song_key":"G#m"}]}',),
            ('{"tonal":{"key_scale":{"value":"minor"}}}',), ('{"tonal":{"key_scale":"x","chords_scale":"Major"}}',)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, p string")
    df = P.with_deezer_bpm(df, "p", "dz")
    df = P.with_search_bpm_mode(df, "p", "sb", "sm")
    df = P.with_tonal_mode(df, "p", "tm")
    got = [tuple(r) for r in df.orderBy("i").select("dz", "sb", "sm", "tm").collect()]
    assert got[0] == (120.5, None, None, None)
    assert got[1][0] is None and got[2][0] is None and got[3] == (None, None, None, None)
    assert got[4][1:3] == (99.0, "Major")
    assert got[5][1:3] == (None, "Minor")          # bad BPM, mode kept
    assert got[6][3] == "Minor" and got[7][3] == "Major"
    prev = df.orderBy("i").select(P.deezer_preview("p")).collect()[0][0]
    assert prev == "u"


def test_provider_pivot_keeps_first_hit(spark):
    resp = spark.createDataFrame([("k", "p1_bpm", 2, '{"data":[{"bpm":90}]}'), ("k", "p1_bpm", 1, None),
                                  ("k", "p2_preview", 1, '{"bpm": 70, "mode": "Minor"}')],
                                 "song_key string, provider string, rank int, payload string")
    pv = provider_pivot(resp).collect()[0]
    assert pv.p1_bpm is None and pv.p2_preview is not None
    parsed = parse_providers(provider_pivot(resp)).collect()[0]
    assert parsed.p1_bpm is None and parsed.p2_bpm == 70.0 and parsed.p2_mode == "Minor"


def test_chain_labels(spark):
    tracks = spark.createDataFrame([("a", "100", None), ("b", None, None), ("c", " ", "Major"), ("d", None, None)],
                                   "song_key string, bpm string, mode string")
    prov = spark.createDataFrame([("b", None, 80.0, "Minor", None, None, None, None),
                                  ("c", 0.0, None, None, None, None, 60.0, None)], PROV_DDL)
    cache = spark.createDataFrame([("a", 1.0, "Major"), ("c", None, None)], "song_key string, bpm double, mode string")
    out = {r.song_key: r for r in enrich_chain(tracks, prov, cache).collect()}
    assert (out["a"].bpm, out["a"].bpm_source, out["a"].mode, out["a"].mode_source) == (100.0, None, "Major", "cache")
    assert (out["b"].bpm, out["b"].bpm_source, out["b"].mode_source) == (80.0, C.PROVIDER_LABELS["p2_preview"],
                                                                         C.PROVIDER_LABELS["p2_preview"])
    assert (out["c"].bpm, out["c"].bpm_source) == (0.0, C.PROVIDER_LABELS["p1_bpm"])
    assert out["d"].bpm is None and out["d"].bpm_source is None


# --- fold --------------------------------------------------------------------

def brute_fold(rows, prov, cache):
    """Reference: the original per-row loop over a dict cache."""
    state = dict(cache)
    out = []
    for key, own_b, own_m in rows:
        pb, pm = prov.get(key, (None, None))
        b, m, sb, sm = own_b, own_m, None, None
        if key in state:
            cb, cm = state[key]
            if b is None and cb is not None:
                b, sb = cb, "cache"
            if m is None and cm is not None:
                m, sm = cm, "cache"
            if b is not None and m is not None:
                out.append((b, m, sb, sm))
                continue
        if b is None and pb is not None:
            b, sb = pb, sb or "P"
        if m is None and pm is not None:
            m, sm = pm, sm or "P"
        state[key] = (b, m)
        out.append((b, m, sb, sm))
    return out, state


def _run_fold(spark, rows, prov, cache, chunk_rows=None):
    t = spark.createDataFrame([(i, k, b, m) for i, (k, b, m) in enumerate(rows)],
                              "_row long, song_key string, bpm double, mode string")
    p = spark.createDataFrame([(k, b, None, m, None, None, None, None) for k, (b, m) in prov.items()], PROV_DDL)
    c = spark.createDataFrame([(k, b, m) for k, (b, m) in cache.items()], "song_key string, bpm double, mode string")
    out, snap = enrich_fold(t, p, c, chunk_rows=chunk_rows)
    got = {r._row: (r.bpm, r.mode, r.bpm_source, r.mode_source) for r in out.collect()}
    labels = {C.PROVIDER_LABELS["p1_bpm"]: "P", C.PROVIDER_LABELS["p2_preview"]: "P"}
    rows_out = [tuple(labels.get(x, x) if j >= 2 else x for j, x in enumerate(got[i])) for i in range(len(rows))]
    return rows_out, {r.song_key: (r.bpm, r.mode) for r in snap.collect()}


def test_fold_fixtures(spark):
    rows = [("k", None, "Major"), ("k", 100.0, None), ("k", None, None),
            ("j", 90.0, "Minor"), ("j", None, None),
            ("h", None, None), ("h", 100.0, None), ("h", None, "Minor")]
    got, snap = _run_fold(spark, rows, {}, {})
    assert [g[:2] for g in got] == [(None, "Major"), (100.0, "Major"), (None, "Major"),
                                    (90.0, "Minor"), (90.0, "Minor"),
                                    (None, None), (100.0, None), (100.0, "Minor")]
    assert got[4][2:] == ("cache", "cache")
    # early return on the last row of "h" leaves the cached entry as written by row 2
    assert snap["k"] == (None, "Major") and snap["h"] == (100.0, None)


def test_fold_matches_brute_force_random(spark):
    rnd = random.Random(7)
    keys = ["a", "b", "c", "d", "e"]
    rows = [(rnd.choice(keys), rnd.choice([None, None, float(rnd.randint(60, 140))]),
             rnd.choice([None, None, "Major", "Minor"])) for _ in range(300)]
    prov = {k: (rnd.choice([None, 70.0]), rnd.choice([None, "Major"])) for k in keys[:4]}
    cache = {"a": (None, None), "b": (88.0, None), "c": (None, "Minor"), "d": (77.0, "Major")}
    want, state = brute_fold(rows, prov, cache)
    for chunk in (None, 7, 1):
        got, snap = _run_fold(spark, rows, prov, cache, chunk_rows=chunk)
        assert got == want, chunk
        assert snap == state, chunk


def test_offchain_payload_parsers(spark):
    rows = [('{"recordings": [{"id": "mb-1"}], "rhythm": {"bpm": {"value": "128.5"}}, '
             '"tonal": {"key_key": {"value": "C"}, "key_scale": {"value": "minor"}}, '
             '"results": [{"previewUrl": "http://x/p.m4a"}]}',),
            ('{"recordings": [], "rhythm": {"bpm": {"value": null}}, '
             '"tonal": {"key_key": {"value": ""}, "key_scale": {"value": "major"}}, "results": []}',),
            ("nope",)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, p string")
    got = [tuple(r) for r in df.orderBy("i").select(
        P.recording_id("p"), P.rhythm_bpm("p"), P.tonal_key_string("p"), P.itunes_preview("p")).collect()]
    assert got[0] == ("mb-1", 128.5, "C minor", "http://x/p.m4a")
    assert got[1] == (None, None, None, None)          # empty key name: no key string
    assert got[2] == (None, None, None, None)


def test_fold_without_cache_equals_empty_cache(spark):
    rows = [("a", None, None), ("a", 90.0, None), ("b", None, "Minor"), ("a", None, "Major")]
    t = spark.createDataFrame([(i, k, b, m) for i, (k, b, m) in enumerate(rows)],
                              "_row long, song_key string, bpm double, mode string")
    p = spark.createDataFrame([("a", 70.0, None, None, None, None, None, None)], PROV_DDL)
    empty = spark.createDataFrame([], "song_key string, bpm double, mode string")
    with_none, snap_none = enrich_fold(t, p, None)
    with_empty, snap_empty = enrich_fold(t, p, empty)
    key = lambda r: r._row
    assert sorted(with_none.collect(), key=key) == sorted(with_empty.collect(), key=key)
    assert sorted(snap_none.collect()) == sorted(snap_empty.collect())
    want, state = brute_fold(rows, {"a": (70.0, None)}, {})
    got = {r._row: (r.bpm, r.mode) for r in with_none.collect()}
    assert [got[i] for i in range(len(rows))] == [w[:2] for w in want]


def test_prior_last_with_sparse_orders_and_null_keys(spark):
    """Chunks hold their number of rows however far apart the orders are."""
    from cadenza.operators.enrich import prior_last
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", None]), i * 10 ** 9 + rnd.randrange(10 ** 6), rnd.choice([None, i])) for i in range(80)]
    df = spark.createDataFrame(rows, "k string, o long, v int")
    got = {(r.k, r.o): r.p for r in prior_last(df, "k", "o", {"p": "v"}, 7).collect()}
    for k, o, _ in rows:
        before = [v for kk, oo, v in rows if kk == k and oo < o and v is not None]
        assert got[k, o] == (before[-1] if before else None)


def test_skewed_keys_fold_and_merge(spark):
    from cadenza.operators.merge import merge_back
    rnd = random.Random(11)
    keys = ["a", "a", "a", "a", "b", "c"]
    rows = [(rnd.choice(keys), rnd.choice([None, 100.0]), rnd.choice([None, "Minor"])) for _ in range(60)]
    prov = {"a": (70.0, None), "b": (None, "Major")}
    cache = {"a": (None, None), "c": (88.0, None)}
    want, state = brute_fold(rows, prov, cache)
    got, snap = _run_fold(spark, rows, prov, cache, chunk_rows=5)
    assert got == want and snap == state
    orig = spark.createDataFrame([(i, "T", "a" if i % 3 else None) for i in range(30)],
                                 "_row long, title string, artist string")
    final = spark.createDataFrame([(0, " t ", "A", "x"), (1, "t", None, "y")],
                                  "_row long, title string, artist string, note string")
    out = {r._row: r.note for r in merge_back(orig, final).collect()}
    assert len(out) == 30 and all(out[i] == ("x" if i % 3 else "y") for i in range(30))
