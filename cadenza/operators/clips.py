"""Clip analysis hook (INF-3, SRC-8, AGG-8, AGG-10, AGG-11).

Bytes -> frames is the only Python step: a pluggable ``mapInPandas``
analyser turns each clip into frame rows (tempo, 12-bin chroma).  Every
statistic after the frames is native: median tempo, chroma mode, and the
analyser preference (A, unless missing or 0, else B) as a ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import ship_package
from .common import materialised
from .frames import chroma_mode, median_tempo

FRAME_SCHEMA = "clip_id string, frame int, tempo double, chroma array<float>"


def analyse_clips(clips: DataFrame, analyser: Callable, fallback: DataFrame | None = None,
                  label: str = "analyser") -> DataFrame:
    """Per clip (clip_id, content): median frame tempo and chroma mode from
    ``analyser`` (``mapInPandas``: clip_id, content -> FRAME_SCHEMA) for clips of
    at least MIN_CLIP_BYTES; where ``fallback`` (clip_id, bpm, mode) is given it is
    used when the analyser's BPM is missing or 0 and its mode is missing.  Smaller
    clips keep their row, with NULLs.  Sources name the producer."""
    ship_package(clips.sparkSession)
    gated = clips.where(F.octet_length("content") >= C.MIN_CLIP_BYTES).select("clip_id", "content")
    # both statistics read the frames: the analyser runs once
    frames = materialised(gated.mapInPandas(analyser, FRAME_SCHEMA), "clip-frames")
    tempo = median_tempo(frames, "clip_id")
    mode = chroma_mode(frames, "clip_id").select("clip_id", F.col("mode").alias("a_mode"))
    a = tempo.join(mode, "clip_id", "full").select("clip_id", F.col("median_tempo").alias("a_bpm"), "a_mode")
    if fallback is None:
        fallback = clips.sparkSession.createDataFrame([], "clip_id string, bpm double, mode string")
    j = a.join(fallback.select("clip_id", F.col("bpm").alias("b_bpm"), F.col("mode").alias("b_mode")),
               "clip_id", "full")
    a_bpm = F.when(F.col("a_bpm") != 0, F.col("a_bpm"))
    j = clips.select("clip_id").distinct().join(j, "clip_id", "left")
    return j.select(
        "clip_id",
        F.coalesce(a_bpm, F.col("b_bpm")).alias("bpm"),
        F.coalesce(F.col("a_mode"), F.col("b_mode")).alias("mode"),
        F.when(a_bpm.isNotNull(), F.lit(label)).when(F.col("b_bpm").isNotNull(), F.lit("fallback")).alias("bpm_source"),
        F.when(F.col("a_mode").isNotNull(), F.lit(label)).when(F.col("b_mode").isNotNull(), F.lit("fallback"))
         .alias("mode_source"))
