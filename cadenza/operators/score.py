"""Evidence-weighted scoring, letter grades and ranking (DataFrame -> DataFrame).

All row-wise: no shuffle.  Ranking (``rank_by_score``) is a range-partitioned
sort plus per-partition offsets, never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import num
from .common import ensure_columns
from .rank import global_row_number

# feature -> (value column, evidence column, score column, weight column)
FEATURES = {
    "bpm": ("bpm", "bpm_evidence", "bpm_score", "bpm_weight"),
    "mode": ("mode", "mode_evidence", "mode_score", "mode_weight"),
    "lyric_valence": ("lyric_valence", "lyricval_evidence", "lyricval_score", "lyricval_weight"),
    "lyric_arousal": ("lyric_arousal", "lyricaro_evidence", "lyricaro_score", "lyricaro_weight"),
}

SCORE_OUTPUTS = ["bpm_score", "mode_score", "lyricval_score", "lyricaro_score",
                 "bpm_weight", "mode_weight", "lyricval_weight", "lyricaro_weight",
                 "total_score", "letter_grade"]


def fill_evidence_defaults(df: DataFrame, cfg: C.ScoreConfig = C.ScoreConfig()) -> DataFrame:
    """Add absent evidence columns with the feature default; replace NULL or
    blank labels by the default."""
    df = ensure_columns(df, {FEATURES[f][1]: ("string", None) for f in FEATURES})
    return df.withColumns({
        FEATURES[f][1]: num.fill_evidence(FEATURES[f][1], cfg.default_evidence[f])
        for f in FEATURES})


def score_tracks(df: DataFrame, cfg: C.ScoreConfig = C.ScoreConfig()) -> DataFrame:
    """Append feature scores, normalised weights, total score and grade.

    Input columns: bpm DOUBLE, mode STRING, lyric_valence DOUBLE,
    lyric_arousal DOUBLE (absent ones are treated as NULL) and optional
    evidence labels.  Existing output columns are overwritten in place.
    """
    df = ensure_columns(df, {"bpm": ("double", None), "mode": ("string", None),
                             "lyric_valence": ("double", None),
                             "lyric_arousal": ("double", None)})
    df = fill_evidence_defaults(df, cfg)
    scores = {
        "bpm": num.bpm_score(num.nan_to_null(F.col("bpm").cast("double"))),
        "mode": num.mode_score(F.col("mode")),
        "lyric_valence": num.valence_score(num.nan_to_null(F.col("lyric_valence").cast("double"))),
        "lyric_arousal": num.arousal_score(num.nan_to_null(F.col("lyric_arousal").cast("double"))),
    }
    # each step is a projection of its own, so nothing is copied into the next
    df = df.withColumns({FEATURES[f][2]: scores[f] for f in FEATURES} | {
        f"_w_{f}": F.lit(float(cfg.base_weights[f])) * num.evidence_multiplier(FEATURES[f][1], cfg.multipliers)
        for f in FEATURES})
    total_w = None
    for f in FEATURES:
        total_w = F.col(f"_w_{f}") if total_w is None else total_w + F.col(f"_w_{f}")
    df = df.withColumn("_w", total_w)
    df = df.withColumns({FEATURES[f][3]: F.col(f"_w_{f}") / F.col("_w") for f in FEATURES})
    df = df.drop("_w", *(f"_w_{f}" for f in FEATURES))
    total = num.weighted_total([F.col(FEATURES[f][2]) for f in FEATURES],
                               [F.col(FEATURES[f][3]) for f in FEATURES])
    df = df.withColumn("total_score", total)
    return df.withColumn("letter_grade", num.letter_grade(F.col("total_score"), cfg.cutoffs))


def grade_histogram(scored: DataFrame) -> DataFrame:
    """Value counts of the letter grade, most frequent first (ties by grade)."""
    return (scored.groupBy("letter_grade").agg(F.count(F.lit(1)).alias("n_tracks"))
            .orderBy(F.desc("n_tracks"), "letter_grade"))


def rank_by_score(scored: DataFrame, tie_col: str = "_row", rank_col: str = "rank") -> DataFrame:
    """Number the rows 1..n by total score descending, missing last, ties by the
    unique ``tie_col`` (distributed).  Only the two order columns are sorted; the
    rank comes back by a join."""
    narrow = scored.select(tie_col, "total_score")
    ranked = global_row_number(narrow, [F.col("total_score").desc_nulls_last(), F.col(tie_col).asc()], rank_col)
    return scored.join(ranked.select(tie_col, rank_col), tie_col)
