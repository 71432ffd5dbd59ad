"""Scoring plans over the driver tables: part plays the track list, orders
supplies the evidence tiers (order with o_orderkey = p_partkey)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.merge import preview
from ..operators.score import grade_histogram, rank_by_score, score_tracks
from .base import dbl, load, round_doubles

# Adapter values: how the driver columns become track attributes.
MODE_BY_TYPE = {"STANDARD": "Major", "ECONOMY": " minor ", "MEDIUM": "Dorian",
                "PROMO": "mixolydian", "LARGE": "Phrygian"}  # SMALL -> NULL
BPM_EVIDENCE_BY_PRIORITY = {"1-URGENT": "RCT", "2-HIGH": " Meta ", "3-MEDIUM": "observational",
                            "4-NOT SPECIFIED": "  "}  # 5-LOW -> NULL
MODE_EVIDENCE_BY_STATUS = {"F": "clinical", "O": "anecdotal"}  # else unknown tier
AROUSAL_EVIDENCE_BY_PRIORITY = {"5-LOW": "indirect", "1-URGENT": "mechanistic"}  # else ''


def _case(col, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default).cast("string"))


def affect_columns() -> dict:
    """BPM, mode and lyric affect of a part row (no evidence)."""
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return {
        "bpm": (F.lit(40) + F.lit(2) * F.col("p_size")).cast("double"),
        "mode": _case(F.col("p_type"), MODE_BY_TYPE),
        "lyric_valence": F.when(cents % 7 != 0, (cents % 151 - 50).cast("double") / F.lit(100.0)),
        "lyric_arousal": F.when(cents % 5 != 0, (cents * 3 % 131 - 30).cast("double") / F.lit(100.0)),
    }


def affect_view(part):
    return part.select("p_partkey", *[c.alias(n) for n, c in affect_columns().items()])


def track_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One track per part row with BPM, mode, lyric affect and evidence."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                  "o_orderpriority")
    tracks = affect_view(part)
    evidence = orders.select(
        F.col("o_orderkey"),
        _case(F.col("o_orderpriority"), BPM_EVIDENCE_BY_PRIORITY).alias("bpm_evidence"),
        _case(F.col("o_orderstatus"), MODE_EVIDENCE_BY_STATUS, "unknown tier").alias("mode_evidence"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("systematic"))
         .when(F.col("o_custkey") % 3 == 1, F.lit("theoretical")).alias("lyricval_evidence"),
        _case(F.col("o_orderpriority"), AROUSAL_EVIDENCE_BY_PRIORITY, "").alias("lyricaro_evidence"),
    )
    return (tracks.join(evidence, tracks["p_partkey"] == evidence["o_orderkey"], "left")
            .drop("o_orderkey"))


def q_score_tracks(spark, sf_dir):
    return round_doubles(score_tracks(track_view(spark, sf_dir)))


def q_grade_histogram(spark, sf_dir):
    return grade_histogram(score_tracks(track_view(spark, sf_dir)))


def q_rank_tracks(spark, sf_dir):
    scored = score_tracks(track_view(spark, sf_dir))
    ranked = rank_by_score(scored, tie_col="p_partkey")
    return round_doubles(ranked.select("p_partkey", "total_score", "letter_grade", "rank"))


def q_preview_head(spark, sf_dir):
    """First three scored tracks in input order (the diagnostic head)."""
    scored = score_tracks(track_view(spark, sf_dir)).withColumnRenamed("p_partkey", "_row")
    return round_doubles(preview(scored, 3).select(F.col("_row").alias("p_partkey"), "total_score",
                                                   "letter_grade"))


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

def _sql_case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _decay_sql(x: str, lo, hi, hmin, hmax) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN {x} >= {dbl(lo)} AND {x} <= {dbl(hi)} THEN {dbl(1.0)} "
            f"WHEN {x} < {dbl(lo)} THEN CASE WHEN {x} <= {dbl(hmin)} THEN {dbl(0.0)} "
            f"ELSE ({x} - {dbl(float(hmin))}) / {dbl(float(lo - hmin))} END "
            f"WHEN {x} > {dbl(hi)} THEN CASE WHEN {x} >= {dbl(hmax)} THEN {dbl(0.0)} "
            f"ELSE {dbl(1.0)} - ({x} - {dbl(float(hi))}) / {dbl(float(hmax - hi))} END "
            f"ELSE {dbl(0.0)} END")


def _mult_sql(label: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {dbl(v)}" for k, v in C.EVIDENCE_MULTIPLIERS.items())
    return f"CASE trim(lower({label})) {whens} ELSE {dbl(1.0)} END"


def _grade_sql(x: str) -> str:
    whens = " ".join(f"WHEN 100 * {x} >= {cut} THEN '{g}'"
                     for g, cut in C.LETTER_CUTOFFS.items())
    return f"CASE WHEN {x} IS NULL THEN 'N/A' {whens} ELSE 'F' END"


AFFECT_SQL = f"""
      SELECT p_partkey,
             CAST(40 + 2 * p_size AS DOUBLE) AS bpm,
             {_sql_case('p_type', MODE_BY_TYPE)} AS mode,
             CASE WHEN c % 7 <> 0 THEN CAST(c % 151 - 50 AS DOUBLE) / {dbl(100.0)} END AS lyric_valence,
             CASE WHEN c % 5 <> 0 THEN CAST(c * 3 % 131 - 30 AS DOUBLE) / {dbl(100.0)} END AS lyric_arousal
      FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part) p"""


def scored_sql() -> str:
    """SELECT producing the unrounded scored track view (CTE body)."""
    mode_scores = " ".join(f"WHEN '{k}' THEN {dbl(v)}" for k, v in C.MODE_SCORES.items())
    ev = C.DEFAULT_EVIDENCE
    return f"""
    WITH base AS (
      SELECT p_partkey,
             CAST(40 + 2 * p_size AS DOUBLE) AS bpm,
             {_sql_case('p_type', MODE_BY_TYPE)} AS mode,
             CASE WHEN c % 7 <> 0 THEN CAST(c % 151 - 50 AS DOUBLE) / {dbl(100.0)} END AS lyric_valence,
             CASE WHEN c % 5 <> 0 THEN CAST(c * 3 % 131 - 30 AS DOUBLE) / {dbl(100.0)} END AS lyric_arousal,
             {_sql_case('o_orderpriority', BPM_EVIDENCE_BY_PRIORITY)} AS bpm_ev_raw,
             {_sql_case('o_orderstatus', MODE_EVIDENCE_BY_STATUS, "'unknown tier'")} AS mode_ev_raw,
             CASE WHEN o_custkey % 3 = 0 THEN 'systematic' WHEN o_custkey % 3 = 1 THEN 'theoretical' END
               AS val_ev_raw,
             {_sql_case('o_orderpriority', AROUSAL_EVIDENCE_BY_PRIORITY, "''")} AS aro_ev_raw
      FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part) p
      LEFT JOIN orders o ON o.o_orderkey = p.p_partkey
    ), ev AS (
      SELECT p_partkey, bpm, mode, lyric_valence, lyric_arousal,
        CASE WHEN bpm_ev_raw IS NULL OR trim(bpm_ev_raw) = '' THEN '{ev['bpm']}' ELSE bpm_ev_raw END AS bpm_evidence,
        CASE WHEN mode_ev_raw IS NULL OR trim(mode_ev_raw) = '' THEN '{ev['mode']}' ELSE mode_ev_raw END AS mode_evidence,
        CASE WHEN val_ev_raw IS NULL OR trim(val_ev_raw) = '' THEN '{ev['lyric_valence']}' ELSE val_ev_raw END AS lyricval_evidence,
        CASE WHEN aro_ev_raw IS NULL OR trim(aro_ev_raw) = '' THEN '{ev['lyric_arousal']}' ELSE aro_ev_raw END AS lyricaro_evidence
      FROM base
    ), sc AS (
      SELECT *,
        greatest({_decay_sql('bpm', *C.BPM_RANGES[0])}, {_decay_sql('bpm', *C.BPM_RANGES[1])}) AS bpm_score,
        CASE WHEN mode IS NULL THEN NULL ELSE CASE lower(trim(mode)) {mode_scores} ELSE {dbl(C.MODE_SCORE_OTHER)} END END AS mode_score,
        {_decay_sql('lyric_valence', *C.VALENCE_RANGE)} AS lyricval_score,
        {_decay_sql('lyric_arousal', *C.AROUSAL_RANGE)} AS lyricaro_score,
        {dbl(C.BASE_WEIGHTS['bpm'])} * {_mult_sql('bpm_evidence')} AS e1,
        {dbl(C.BASE_WEIGHTS['mode'])} * {_mult_sql('mode_evidence')} AS e2,
        {dbl(C.BASE_WEIGHTS['lyric_valence'])} * {_mult_sql('lyricval_evidence')} AS e3,
        {dbl(C.BASE_WEIGHTS['lyric_arousal'])} * {_mult_sql('lyricaro_evidence')} AS e4
      FROM ev
    ), w AS (
      SELECT *, e1 / (e1 + e2 + e3 + e4) AS bpm_weight, e2 / (e1 + e2 + e3 + e4) AS mode_weight,
             e3 / (e1 + e2 + e3 + e4) AS lyricval_weight, e4 / (e1 + e2 + e3 + e4) AS lyricaro_weight
      FROM sc
    ), t AS (
      SELECT *,
        coalesce(bpm_score * bpm_weight, 0.0::DOUBLE) + coalesce(mode_score * mode_weight, 0.0::DOUBLE)
          + coalesce(lyricval_score * lyricval_weight, 0.0::DOUBLE)
          + coalesce(lyricaro_score * lyricaro_weight, 0.0::DOUBLE) AS numer,
        CASE WHEN bpm_score IS NOT NULL THEN bpm_weight ELSE 0.0::DOUBLE END
          + CASE WHEN mode_score IS NOT NULL THEN mode_weight ELSE 0.0::DOUBLE END
          + CASE WHEN lyricval_score IS NOT NULL THEN lyricval_weight ELSE 0.0::DOUBLE END
          + CASE WHEN lyricaro_score IS NOT NULL THEN lyricaro_weight ELSE 0.0::DOUBLE END AS denom
      FROM w
    ), scored AS (
      SELECT p_partkey, bpm, mode, lyric_valence, lyric_arousal,
             bpm_evidence, mode_evidence, lyricval_evidence, lyricaro_evidence,
             bpm_score, mode_score, lyricval_score, lyricaro_score,
             bpm_weight, mode_weight, lyricval_weight, lyricaro_weight,
             CASE WHEN denom <> 0 THEN numer / denom END AS total_score
      FROM t
    )"""


def _r(c: str) -> str:
    return f"round({c}, 6) AS {c}"


ORACLE = {
    "preview_head": scored_sql() + f"""
    SELECT p_partkey, {_r('total_score')}, {_grade_sql('total_score')} AS letter_grade
    FROM scored ORDER BY p_partkey LIMIT 3""",
    "score_tracks": scored_sql() + f"""
    SELECT p_partkey, {_r('bpm')}, mode, {_r('lyric_valence')}, {_r('lyric_arousal')},
           bpm_evidence, mode_evidence, lyricval_evidence, lyricaro_evidence,
           {_r('bpm_score')}, {_r('mode_score')}, {_r('lyricval_score')}, {_r('lyricaro_score')},
           {_r('bpm_weight')}, {_r('mode_weight')}, {_r('lyricval_weight')}, {_r('lyricaro_weight')},
           {_r('total_score')}, {_grade_sql('total_score')} AS letter_grade
    FROM scored""",
    "grade_histogram": scored_sql() + f"""
    SELECT letter_grade, count(*) AS n_tracks
    FROM (SELECT {_grade_sql('total_score')} AS letter_grade FROM scored)
    GROUP BY letter_grade""",
    "rank_tracks": scored_sql() + f"""
    SELECT p_partkey, {_r('total_score')}, {_grade_sql('total_score')} AS letter_grade,
           row_number() OVER (ORDER BY total_score DESC NULLS LAST, p_partkey) AS rank
    FROM scored""",
}

QUERIES = {
    "preview_head": q_preview_head,
    "score_tracks": q_score_tracks,
    "grade_histogram": q_grade_histogram,
    "rank_tracks": q_rank_tracks,
}
