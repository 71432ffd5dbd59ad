"""Enrichment plans: events play the provider responses (user = song key,
event type = provider, earliest (ts, event_id) = the hit, props.k drives
the payload shape), 'error' events the cache; part plays the batch for the
order-dependent fold (key = lower(p_name), input order = p_partkey)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators.enrich import enrich_chain, enrich_fold, parse_providers, provider_pivot
from .base import load, round_doubles

PROVIDER_BY_EVENT = {"view": "p1_bpm", "click": "p2_preview", "purchase": "p3_search",
                     "signup": "p4_preview"}
KEY_STRINGS = ("C major", "A Minor", "G#m", "C#", "Am ")   # by k % 5


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def _key_string(k):
    out = None
    for i, s in enumerate(KEY_STRINGS):
        out = F.when(k % 5 == i, F.lit(s)) if out is None else out.when(k % 5 == i, F.lit(s))
    return out


def provider_responses(spark, sf_dir):
    ev = load(spark, sf_dir, "events").where(F.col("event_type").isin(*PROVIDER_BY_EVENT))
    k, v, et = _k(), F.col("value"), F.col("event_type")
    prov = None
    for e, p in PROVIDER_BY_EVENT.items():
        prov = F.when(et == e, F.lit(p)) if prov is None else prov.when(et == e, F.lit(p))
    preview = F.concat(F.lit("https://cdn.example.net/p/"), F.col("event_id").cast("string"), F.lit(".mp3"))
    p1 = F.when(k.between(10, 14), F.lit('{"data": []}')).otherwise(F.to_json(F.struct(
        F.array(F.struct(F.when(k < 10, F.lit(0.0)).otherwise(v).alias("bpm"),
                         preview.alias("preview"))).alias("data"))))
    p2 = F.to_json(F.struct(F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(v).alias("bpm"),
                            F.when(k % 3 == 0, F.lit("Major")).when(k % 3 == 1, F.lit("Minor")).alias("mode"),
                            F.when(k % 5 == 0, F.lit("madmom")).when(k % 5 == 1, F.lit(" ")).alias("bpm_producer"),
                            F.when(k % 4 == 1, F.lit("pyACA")).alias("mode_producer")))
    tempo_text = F.when(k % 9 == 0, F.lit("fast")).otherwise(v.cast("string"))
    p3 = F.when(k % 2 == 0, F.to_json(F.struct(F.array(F.struct(
        tempo_text.alias("tempo"), _key_string(k).alias("key"))).alias("search"))))\
        .otherwise(F.to_json(F.struct(F.array().cast("array<string>").alias("search"), F.array(F.struct(
            F.lit(0).alias("tempo"), v.alias("bpm"), _key_string(k).alias("song_key"))).alias("result"))))
    p4 = F.to_json(F.struct(v.alias("bpm"), F.when(k % 2 == 0, F.lit("Minor")).otherwise(F.lit("Major")).alias("mode")))
    body = (F.when(et == "view", p1).when(et == "click", p2).when(et == "purchase", p3).otherwise(p4))
    return ev.select(F.col("user_id").cast("string").alias("song_key"), prov.alias("provider"),
                     "ts", "event_id", body.alias("payload"))


def event_cache(spark, sf_dir):
    ev = load(spark, sf_dir, "events").where(F.col("event_type") == "error")
    k = _k()
    rows = ev.select(F.col("user_id").cast("string").alias("song_key"), "ts", "event_id",
                     F.when(k % 3 != 0, F.col("value")).alias("bpm"),
                     F.when(k % 2 == 0, F.lit("Major")).alias("mode"))
    first = rows.groupBy("song_key").agg(F.min_by(F.struct("bpm", "mode"), F.struct("ts", "event_id")).alias("e"))
    return first.select("song_key", "e.bpm", "e.mode")


def event_tracks(spark, sf_dir):
    users = load(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    return users.select(
        u.cast("string").alias("song_key"),
        F.when(u % 4 == 0, (F.lit(100) + u % 50).cast("string")).when(u % 4 == 1, F.lit("n/a")).alias("bpm"),
        F.when(u % 6 == 0, F.lit("Minor")).when(u % 6 == 1, F.lit("  ")).alias("mode"))


def q_provider_chain(spark, sf_dir):
    pivot = provider_pivot(provider_responses(spark, sf_dir), "song_key", order=["ts", "event_id"])
    out = enrich_chain(event_tracks(spark, sf_dir), parse_providers(pivot), event_cache(spark, sf_dir))
    return round_doubles(out.select("song_key", "bpm", "mode", "bpm_source", "mode_source"))


# --- fold -------------------------------------------------------------------

def fold_inputs(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    size = F.col("p_size")
    tracks = part.select(
        F.col("p_partkey").alias("_row"), "p_partkey", F.lower("p_name").alias("song_key"),
        F.when(size % 3 == 0, (F.lit(40) + F.lit(2) * size).cast("double")).alias("bpm"),
        F.when(size % 4 == 0, F.when(F.col("p_type").isin("STANDARD", "PROMO"), F.lit("Major"))
               .otherwise(F.lit("Minor"))).alias("mode"))
    names = part.select(F.lower("p_name").alias("song_key"), F.length("p_name").alias("n")).distinct()
    n = F.col("n")
    null_d, null_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    providers = names.select(
        "song_key", F.when(n % 2 == 0, (F.lit(60) + n).cast("double")).alias("p1_bpm"),
        null_d.alias("p2_bpm"), F.when(F.col("song_key").contains("e"), F.lit("Major")).alias("p2_mode"),
        null_d.alias("p3_bpm"), null_s.alias("p3_mode"), null_d.alias("p4_bpm"), null_s.alias("p4_mode"))
    cache = names.where(n % 3 == 0).select(
        "song_key", F.when(n % 2 == 1, F.lit(90.0)).alias("bpm"),
        F.when(F.col("song_key").contains("a"), F.lit("Minor")).alias("mode"))
    return tracks, providers, cache


def q_enrich_fold(spark, sf_dir):
    tracks, providers, cache = fold_inputs(spark, sf_dir)
    rows, _ = enrich_fold(tracks, providers, cache, key="song_key", order="_row")
    return round_doubles(rows.select("p_partkey", "song_key", "bpm", "mode", "bpm_source", "mode_source"))


def q_enrich_fold_cache(spark, sf_dir):
    tracks, providers, cache = fold_inputs(spark, sf_dir)
    _, snap = enrich_fold(tracks, providers, cache, key="song_key", order="_row")
    return round_doubles(snap)


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

L = C.PROVIDER_LABELS
_ks = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(KEY_STRINGS))
_NUM7 = (f"CASE WHEN ks IS NULL OR ks = '' THEN NULL WHEN contains(lower(ks), 'major') THEN 'Major' "
         f"WHEN contains(lower(ks), 'minor') OR suffix(lower(ks), 'm') THEN 'Minor' END")

_CHAIN_SQL = f"""WITH ev AS (
      SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
      FROM events
    ), f AS (SELECT * FROM ev WHERE rn = 1),
    p1 AS (SELECT user_id, CASE WHEN k BETWEEN 10 AND 14 OR k < 10 THEN NULL WHEN value > 0 THEN value END AS b
           FROM f WHERE event_type = 'view'),
    p2 AS (SELECT user_id, CASE WHEN k % 7 = 0 THEN NULL ELSE value END AS b,
                  CASE k % 3 WHEN 0 THEN 'Major' WHEN 1 THEN 'Minor' END AS m,
                  CASE WHEN k % 5 = 0 THEN 'madmom' ELSE '{L['p2_preview']}' END AS bl,
                  CASE WHEN k % 4 = 1 THEN 'pyACA' ELSE '{L['p2_preview']}' END AS ml FROM f WHERE event_type = 'click'),
    p3 AS (SELECT user_id, CASE WHEN k % 2 = 0 AND k % 9 = 0 THEN NULL ELSE value END AS b,
                  {_NUM7.replace('ks', f'(CASE k % 5 {_ks} END)')} AS m FROM f WHERE event_type = 'purchase'),
    p4 AS (SELECT user_id, value AS b, CASE WHEN k % 2 = 0 THEN 'Minor' ELSE 'Major' END AS m
           FROM f WHERE event_type = 'signup'),
    c AS (SELECT user_id, CASE WHEN k % 3 <> 0 THEN value END AS b, CASE WHEN k % 2 = 0 THEN 'Major' END AS m
          FROM f WHERE event_type = 'error'),
    t AS (SELECT user_id,
            CASE WHEN user_id % 4 = 0 THEN CAST(100 + user_id % 50 AS DOUBLE) END AS ob,
            CASE WHEN user_id % 6 = 0 THEN 'Minor' END AS om
          FROM (SELECT DISTINCT user_id FROM events))
    SELECT CAST(t.user_id AS VARCHAR) AS song_key,
      round(coalesce(t.ob, c.b, p1.b, p2.b, p3.b, p4.b), 6) AS bpm,
      coalesce(t.om, c.m, p2.m, p3.m, p4.m) AS mode,
      CASE WHEN t.ob IS NOT NULL THEN NULL WHEN c.b IS NOT NULL THEN 'cache' WHEN p1.b IS NOT NULL THEN '{L['p1_bpm']}'
           WHEN p2.b IS NOT NULL THEN p2.bl WHEN p3.b IS NOT NULL THEN '{L['p3_search']}'
           WHEN p4.b IS NOT NULL THEN '{L['p4_preview']}' END AS bpm_source,
      CASE WHEN t.om IS NOT NULL THEN NULL WHEN c.m IS NOT NULL THEN 'cache'
           WHEN p2.m IS NOT NULL THEN p2.ml WHEN p3.m IS NOT NULL THEN '{L['p3_search']}'
           WHEN p4.m IS NOT NULL THEN '{L['p4_preview']}' END AS mode_source
    FROM t LEFT JOIN c USING (user_id) LEFT JOIN p1 USING (user_id) LEFT JOIN p2 USING (user_id)
      LEFT JOIN p3 USING (user_id) LEFT JOIN p4 USING (user_id)"""


def _step(pres: str, sb: str, sm: str) -> str:
    """Outputs and next state of one fold step (x = current row)."""
    b0 = f"coalesce(x.ob, CASE WHEN {pres} THEN {sb} END)"
    m0 = f"coalesce(x.om, CASE WHEN {pres} THEN {sm} END)"
    early = f"({pres} AND {b0} IS NOT NULL AND {m0} IS NOT NULL)"
    out_b, out_m = f"coalesce({b0}, x.pb)", f"coalesce({m0}, x.pm)"
    return f"""x.k, x.rn, x.p_partkey, {out_b} AS bpm, {out_m} AS mode,
        CASE WHEN x.ob IS NOT NULL THEN NULL WHEN {pres} AND {sb} IS NOT NULL THEN 'cache'
             WHEN x.pb IS NOT NULL THEN '{L['p1_bpm']}' END AS bpm_source,
        CASE WHEN x.om IS NOT NULL THEN NULL WHEN {pres} AND {sm} IS NOT NULL THEN 'cache'
             WHEN x.pm IS NOT NULL THEN '{L['p2_preview']}' END AS mode_source,
        TRUE AS pres, CASE WHEN {early} THEN {sb} ELSE {out_b} END AS sb,
        CASE WHEN {early} THEN {sm} ELSE {out_m} END AS sm"""


_FOLD_SQL = f"""WITH RECURSIVE r AS (
      SELECT lower(p_name) AS k, p_partkey, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS rn,
             CASE WHEN p_size % 3 = 0 THEN CAST(40 + 2 * p_size AS DOUBLE) END AS ob,
             CASE WHEN p_size % 4 = 0 THEN CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 'Major' ELSE 'Minor' END END AS om
      FROM part
    ), names AS (SELECT DISTINCT lower(p_name) AS k, length(p_name) AS n FROM part),
    prov AS (SELECT k, CASE WHEN n % 2 = 0 THEN CAST(60 + n AS DOUBLE) END AS pb,
                    CASE WHEN contains(k, 'e') THEN 'Major' END AS pm FROM names),
    cache AS (SELECT k, CASE WHEN n % 2 = 1 THEN 90.0::DOUBLE END AS cb,
                     CASE WHEN contains(k, 'a') THEN 'Minor' END AS cm FROM names WHERE n % 3 = 0),
    x AS (SELECT r.*, prov.pb, prov.pm, cache.k IS NOT NULL AS cpres, cache.cb, cache.cm
          FROM r LEFT JOIN prov USING (k) LEFT JOIN cache USING (k)),
    fold AS (
      SELECT {_step('x.cpres', 'x.cb', 'x.cm')} FROM x WHERE x.rn = 1
      UNION ALL
      SELECT {_step('f.pres', 'f.sb', 'f.sm')} FROM fold f JOIN x ON x.k = f.k AND x.rn = f.rn + 1
    )"""

ORACLE = {
    "provider_chain": _CHAIN_SQL,
    "enrich_fold": _FOLD_SQL + """
        SELECT p_partkey, k AS song_key, round(bpm, 6) AS bpm, mode, bpm_source, mode_source FROM fold""",
    "enrich_fold_cache": _FOLD_SQL + """
        SELECT k AS song_key, round(sb, 6) AS bpm, sm AS mode
        FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rn DESC) AS last FROM fold) WHERE last = 1""",
}

QUERIES = {
    "provider_chain": q_provider_chain,
    "enrich_fold": q_enrich_fold,
    "enrich_fold_cache": q_enrich_fold_cache,
}
