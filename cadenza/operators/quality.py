"""Lyric quality report (FN-S10, FN-S11, AGG-1, PRJ-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text


def classify_lyrics(df: DataFrame, lyrics_col: str = "lyrics",
                    cfg: C.LyricStatusConfig = C.LyricStatusConfig()) -> DataFrame:
    """Append ``word_count`` and ``lyrics_status``."""
    low = df.withColumn("_low", F.lower(text.strip(lyrics_col)))
    return low.withColumns({"word_count": text.word_count(lyrics_col),
                            "lyrics_status": text.lyric_status(lyrics_col, cfg, low="_low")}).drop("_low")


def status_counts(classified: DataFrame) -> DataFrame:
    """Value counts of the status, most frequent first, ties by status."""
    return (classified.groupBy("lyrics_status").agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), "lyrics_status"))


def flagged_rows(classified: DataFrame, statuses=C.FLAGGED_STATUSES) -> DataFrame:
    """Rows whose status is one of the flagged classes (not GOOD)."""
    return classified.where(F.col("lyrics_status").isin(list(statuses)))
