"""Clean-and-gate stage (FN-S5/S6, PRJ-3..10, SET-1, AGG-4).

One narrow projection: every rule is a column expression, so the whole
stage is a single whole-stage-codegen span with no shuffle.  The split into
READY/HOLD is a filter on a never-NULL boolean (or one partitioned write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import num, text
from .common import ensure_columns

GATE_COLUMNS = {
    "title": ("string", None), "artist": ("string", None), "track_id": ("string", None),
    "source_link": ("string", None), "bpm": ("string", None), "mode": ("string", None),
    "lyric_valence": ("string", None), "lyric_arousal": ("string", None),
    "lyrics": ("string", None), "bpm_source": ("string", None), "mode_source": ("string", None),
    "curator": ("string", None), "date_added": ("string", None),
}


def gate_tracks(df: DataFrame, run_date: str, lyrics_cleaner=text.clean_lyrics_gate) -> DataFrame:
    """Repair, clean, coerce, set provenance, and flag readiness.

    * Title/Artist: mojibake repair twice; title_new/artist_new once, then
      they replace Title/Artist when present and non-blank (unstripped).
    * Lyrics: gate cleaner.  BPM/valence/arousal: text -> double, bad ->
      NULL; valence and arousal 0 -> NULL (BPM 0 kept).
    * Source labels default to the fixed provenance when a value exists.
    * required_ok: track_id, source_link, bpm, mode, lyric_valence non-NULL
      (arousal not required; blank strings count as present).
    * missing: names of required columns that are NULL *or blank*.
    * date_added: NULL -> ``run_date``.
    """
    df = ensure_columns(df, GATE_COLUMNS)
    # one projection per repair step: the repaired text is used several times by the next one
    df = df.withColumns({c: text.fix_mojibake(F.col(c)) for c in ("title", "artist")})
    new = [c for c in ("title", "artist") if f"{c}_new" in df.columns]
    df = df.withColumns({c: text.fix_mojibake(F.col(c)) for c in ("title", "artist")}
                        | {f"{c}_new": text.fix_mojibake(F.col(f"{c}_new")) for c in new})
    if new:
        df = df.withColumns({c: F.when(text.not_missing(f"{c}_new"), F.col(f"{c}_new")).otherwise(F.col(c)) for c in new})
    df = df.withColumns({
        "lyrics": lyrics_cleaner(F.col("lyrics")),
        "bpm": num.coerce_number("bpm"),
        "lyric_valence": num.zero_to_null(num.coerce_number("lyric_valence")),
        "lyric_arousal": num.zero_to_null(num.coerce_number("lyric_arousal")),
    })
    df = df.withColumns({
        "bpm_source": F.when(F.col("bpm").isNotNull() & F.col("bpm_source").isNull(),
                             F.lit(C.PROVENANCE_DEFAULT)).otherwise(F.col("bpm_source")),
        "mode_source": F.when(F.col("mode").isNotNull() & F.col("mode_source").isNull(),
                              F.lit(C.PROVENANCE_DEFAULT)).otherwise(F.col("mode_source")),
    })
    ok = None
    for c in C.REQUIRED_COLUMNS:
        ok = F.col(c).isNotNull() if ok is None else ok & F.col(c).isNotNull()
    missing = F.concat_ws(", ", *[F.when(text.is_missing(c), F.lit(C.REQUIRED_LABELS[c]))
                                  for c in C.REQUIRED_COLUMNS])
    df = df.withColumns({"required_ok": ok, "missing": missing})
    return df.withColumns({
        "ready_to_score": F.when(F.col("required_ok"), F.lit(C.READY_LABEL)).otherwise(F.lit(C.HOLD_LABEL)),
        "date_added": F.coalesce(F.col("date_added"), F.lit(run_date)),
    })


def split_ready(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ready, needs): complementary filters on the non-NULL flag."""
    return gated.where(F.col("required_ok")), gated.where(~F.col("required_ok"))


def missing_counts(df: DataFrame) -> DataFrame:
    """Row count, missing BPM/Mode counts, READY/HOLD counts (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("bpm").isNull()).alias("missing_bpm"),
        F.count_if(F.col("mode").isNull()).alias("missing_mode"),
        F.count_if(F.col("required_ok")).alias("n_ready"),
        F.count_if(~F.col("required_ok")).alias("n_hold"))
