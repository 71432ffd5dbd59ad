"""Gate and numeric-coercion plans: part + documents play the stage-2 track
table (numerics as text, blanks, zeros, NULLs, mojibake); pages and events
supply raw numeric strings and non-finite values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import num, text
from ..operators.gate import gate_tracks, missing_counts, split_ready
from .base import load, round_doubles
from .lyrics import GATE_MARKERS
from .matching import RUN_DATE

# Literal mojibake fixtures: once-encoded and twice-encoded e-acute.
ONCE_BAD, ONCE_GOOD = " cafÃ©", " café"
TWICE_BAD, TWICE_GOOD = " BeyoncÃ\u0083Â©", " Beyoncé"
MODE_TEXT = {"STANDARD": "Major", "ECONOMY": "Minor", "MEDIUM": "Dorian", "LARGE": "  "}


def gate_input(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("p_partkey"),
                                                   F.col("text").alias("lyrics"))
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    mode = None
    for k, v in MODE_TEXT.items():
        mode = F.when(F.col("p_type") == k, F.lit(v)) if mode is None else mode.when(F.col("p_type") == k, F.lit(v))
    rows = part.select(
        "p_partkey",
        F.when(size % 10 == 0, F.lit(None).cast("string")).when(size % 10 == 1, F.lit("  "))
         .otherwise(F.concat(F.lit("trk"), key)).alias("track_id"),
        F.when(size % 8 == 0, F.concat("p_name", F.lit(ONCE_BAD))).otherwise(F.col("p_name")).alias("title"),
        F.when(size % 8 == 1, F.concat("p_brand", F.lit(TWICE_BAD))).otherwise(F.col("p_brand")).alias("artist"),
        F.when(size % 6 == 0, F.upper("p_name")).when(size % 6 == 1, F.lit(" ")).alias("title_new"),
        F.when(size % 5 == 0, F.lower("p_brand")).alias("artist_new"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("https://open.example.net/track/"), key))
         .alias("source_link"),
        F.when(size % 9 == 0, F.lit("abc")).when(size % 9 == 1, F.lit(" 1e2 "))
         .when(size % 9 == 2, F.lit(None).cast("string"))
         .otherwise((F.lit(40) + F.lit(2) * size).cast("string")).alias("bpm"),
        mode.alias("mode"),
        F.when(size % 3 == 0, F.lit("0")).otherwise(F.concat(F.lit("0."), size.cast("string")))
         .alias("lyric_valence"),
        F.when(size % 5 == 0, F.lit("0.0")).otherwise(F.concat(F.lit("0."), (size + 7).cast("string")))
         .alias("lyric_arousal"),
        F.when(size % 2 == 0, F.lit("Deezer(bpm)")).alias("bpm_source"),
        F.when(size % 3 == 0, F.lit("cache")).alias("mode_source"),
        F.lit(None).cast("string").alias("curator"),
        F.when(size > 40, F.concat(F.lit("2023-05-0"), (size % 9 + 1).cast("string"))).alias("date_added"),
    )
    return rows.join(docs, "p_partkey", "left")


def _gated(spark, sf_dir):
    cleaner = lambda c: text.clean_lyrics_gate(c, **GATE_MARKERS)
    return gate_tracks(gate_input(spark, sf_dir), RUN_DATE, cleaner)


GATE_OUT = ["p_partkey", "track_id", "title", "artist", "title_new", "artist_new", "source_link",
            "bpm", "mode", "lyric_valence", "lyric_arousal", "lyrics", "bpm_source", "mode_source",
            "curator", "date_added", "required_ok", "missing", "ready_to_score"]


def q_gate_tracks(spark, sf_dir):
    return round_doubles(_gated(spark, sf_dir).select(*GATE_OUT))


def q_ready_rows(spark, sf_dir):
    return split_ready(_gated(spark, sf_dir))[0].select("p_partkey", "ready_to_score", "missing")


def q_needs_rows(spark, sf_dir):
    return split_ready(_gated(spark, sf_dir))[1].select("p_partkey", "ready_to_score", "missing")


def q_missing_counts(spark, sf_dir):
    return missing_counts(_gated(spark, sf_dir))


def raw_numbers(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"/([0-9]+)", 1)
    k = F.col("page_id") % 8
    raw = (F.when(k == 0, path)
           .when(k == 1, F.concat(F.lit(" "), path, F.lit(".5 ")))
           .when(k == 2, F.concat(path, F.lit("d")))
           .when(k == 3, F.concat(path, F.lit("e2")))
           .when(k == 4, F.concat(F.lit("1_"), path))
           .when(k == 5, F.lit("nan"))
           .when(k == 6, F.lit("-inf"))
           .otherwise(F.regexp_extract("url", r"[?&]page=([0-9]+)", 1)))
    return pages.select("page_id", raw.alias("raw"))


def q_coerce_numeric(spark, sf_dir):
    r = raw_numbers(spark, sf_dir)
    return round_doubles(r.select("page_id", "raw", num.coerce_number("raw").alias("value")))


def q_sanitize_numeric(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    x = (F.when(F.col("event_type") == "error", F.lit(float("nan")))
         .when(F.col("event_type") == "view", F.lit(float("inf")))
         .when(F.col("event_type") == "click", F.lit(float("-inf")))
         .otherwise(F.col("value")))
    return round_doubles(ev.select("event_id", num.sanitize(x).alias("value"),
                                   num.positive_or_null(F.col("value")).alias("positive_value")))


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

_NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _coerce_sql(x: str) -> str:
    s = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN regexp_matches({s}, '{_NUM_RE}') THEN TRY_CAST({s} AS DOUBLE) END"


def _miss(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '')"


_mode_whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODE_TEXT.items())
_GATE_SQL = f"""WITH g0 AS (
      SELECT p.p_partkey,
        CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN '  ' ELSE 'trk' || p.p_partkey END AS track_id,
        CASE WHEN p_size % 8 = 0 THEN p_name || '{ONCE_GOOD}' ELSE p_name END AS title0,
        CASE WHEN p_size % 8 = 1 THEN p_brand || '{TWICE_GOOD}' ELSE p_brand END AS artist0,
        CASE WHEN p_size % 6 = 0 THEN upper(p_name) WHEN p_size % 6 = 1 THEN ' ' END AS title_new,
        CASE WHEN p_size % 5 = 0 THEN lower(p_brand) END AS artist_new,
        CASE WHEN p_type <> 'PROMO' THEN 'https://open.example.net/track/' || p.p_partkey END AS source_link,
        CASE WHEN p_size % 9 = 0 THEN 'abc' WHEN p_size % 9 = 1 THEN ' 1e2 ' WHEN p_size % 9 = 2 THEN NULL
             ELSE CAST(40 + 2 * p_size AS VARCHAR) END AS bpm_raw,
        CASE p_type {_mode_whens} END AS mode,
        CASE WHEN p_size % 3 = 0 THEN '0' ELSE '0.' || p_size END AS val_raw,
        CASE WHEN p_size % 5 = 0 THEN '0.0' ELSE '0.' || (p_size + 7) END AS aro_raw,
        CASE WHEN p_size % 2 = 0 THEN 'Deezer(bpm)' END AS bpm_src0,
        CASE WHEN p_size % 3 = 0 THEN 'cache' END AS mode_src0,
        CAST(NULL AS VARCHAR) AS curator,
        CASE WHEN p_size > 40 THEN '2023-05-0' || (p_size % 9 + 1) END AS date0,
        d.text AS lyrics0
      FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey
    ), g1 AS (
      SELECT *,
        CASE WHEN NOT {_miss('title_new')} THEN title_new ELSE title0 END AS title,
        CASE WHEN NOT {_miss('artist_new')} THEN artist_new ELSE artist0 END AS artist,
        {_coerce_sql('bpm_raw')} AS bpm,
        nullif({_coerce_sql('val_raw')}, 0) AS lyric_valence,
        nullif({_coerce_sql('aro_raw')}, 0) AS lyric_arousal,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(lyrics0,
            '(?is)(^|[^\\pL\\p{{Nd}}_])[0-9]+\\s+this[\\s\\S]*', '\\1', 'g'), '(?is)Version[\\s\\S]*', '', 'g'),
            '(?is)THE!! [0-9]+(?:\\s+THE!! [0-9]+)*', '', 'g'), '^\\s+|\\s+$', '', 'g') AS lyrics
      FROM g0
    ), g AS (
      SELECT p_partkey, track_id, title, artist, title_new, artist_new, source_link, bpm, mode,
        lyric_valence, lyric_arousal, lyrics,
        CASE WHEN bpm IS NOT NULL AND bpm_src0 IS NULL THEN 'spotify/analysis' ELSE bpm_src0 END AS bpm_source,
        CASE WHEN mode IS NOT NULL AND mode_src0 IS NULL THEN 'spotify/analysis' ELSE mode_src0 END AS mode_source,
        curator, coalesce(date0, '{RUN_DATE}') AS date_added,
        (track_id IS NOT NULL AND source_link IS NOT NULL AND bpm IS NOT NULL AND mode IS NOT NULL
         AND lyric_valence IS NOT NULL) AS required_ok,
        concat_ws(', ', CASE WHEN {_miss('track_id')} THEN 'Track ID' END,
                        CASE WHEN {_miss('source_link')} THEN 'Source Link' END,
                        CASE WHEN bpm IS NULL THEN 'BPM' END,
                        CASE WHEN {_miss('mode')} THEN 'Mode' END,
                        CASE WHEN lyric_valence IS NULL THEN 'Lyric sentiment valence' END) AS missing
      FROM g1
    )"""

ORACLE = {
    "gate_tracks": _GATE_SQL + """
        SELECT p_partkey, track_id, title, artist, title_new, artist_new, source_link, round(bpm, 6) AS bpm,
               mode, round(lyric_valence, 6) AS lyric_valence, round(lyric_arousal, 6) AS lyric_arousal, lyrics,
               bpm_source, mode_source, curator, date_added, required_ok, missing,
               CASE WHEN required_ok THEN 'READY' ELSE 'HOLD' END AS ready_to_score
        FROM g""",
    "ready_rows": _GATE_SQL + """
        SELECT p_partkey, 'READY' AS ready_to_score, missing FROM g WHERE required_ok""",
    "needs_rows": _GATE_SQL + """
        SELECT p_partkey, 'HOLD' AS ready_to_score, missing FROM g WHERE NOT required_ok""",
    "missing_counts": _GATE_SQL + """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE bpm IS NULL) AS missing_bpm,
               count(*) FILTER (WHERE mode IS NULL) AS missing_mode,
               count(*) FILTER (WHERE required_ok) AS n_ready, count(*) FILTER (WHERE NOT required_ok) AS n_hold
        FROM g""",
    "coerce_numeric": f"""WITH r AS (
          SELECT page_id, CASE page_id % 8
              WHEN 0 THEN regexp_extract(url, '/([0-9]+)', 1)
              WHEN 1 THEN ' ' || regexp_extract(url, '/([0-9]+)', 1) || '.5 '
              WHEN 2 THEN regexp_extract(url, '/([0-9]+)', 1) || 'd'
              WHEN 3 THEN regexp_extract(url, '/([0-9]+)', 1) || 'e2'
              WHEN 4 THEN '1_' || regexp_extract(url, '/([0-9]+)', 1)
              WHEN 5 THEN 'nan' WHEN 6 THEN '-inf'
              ELSE regexp_extract(url, '[?&]page=([0-9]+)', 1) END AS raw
          FROM pages)
        SELECT page_id, raw, round({_coerce_sql('raw')}, 6) AS value FROM r""",
    "sanitize_numeric": """SELECT event_id,
          round(CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE value END, 6) AS value,
          round(CASE WHEN value > 0 THEN value END, 6) AS positive_value
        FROM events""",
}

QUERIES = {
    "gate_tracks": q_gate_tracks,
    "ready_rows": q_ready_rows,
    "needs_rows": q_needs_rows,
    "missing_counts": q_missing_counts,
    "coerce_numeric": q_coerce_numeric,
    "sanitize_numeric": q_sanitize_numeric,
}
