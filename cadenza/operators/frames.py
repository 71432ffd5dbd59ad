"""Per-track frame statistics (AGG-8..11): median tempo, best candidate
tempo, chroma mode and mono down-mix: hash aggregates with partial
aggregation; the median is a scan over counted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .scan import before


def median_tempo(frames: DataFrame, key: str, tempo: str = "tempo", chunk_rows: int | None = None) -> DataFrame:
    """Exact median of the frame tempi per track (even count: mean of the two
    middle values), NULL tempi ignored, and the number of non-NULL ones.  A
    NULL key is a key; a track without a tempo gets NULL and 0.

    Order statistics over all tasks: equal tempi of a track are counted, the counts
    are sorted by range and summed up before each value, and the values that hold
    the one or two middle ranks are the result.  No group is larger than ``chunk_rows``,
    however many different tempi a track has."""
    v = F.col(tempo).cast("double")
    counts = frames.groupBy(F.col(key).alias("_key"), v.alias("_v")).agg(F.count(v).alias("_n"))
    ranked = before(counts, "_key", "_v", {"_before": ("sum", "_n")}, chunk_rows).where("_v is not null")
    totals = frames.groupBy(F.col(key).alias("_k")).agg(F.count(v).alias("n_frames"))
    low, high = F.floor((F.col("n_frames") - 1) / 2), F.floor(F.col("n_frames") / 2)
    holds = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
    rows = totals.join(ranked, F.col("_k").eqNullSafe(F.col("_key")), "left")
    # other values of the track are NULL here, so an aggregate keeps the middle ones alone
    return rows.groupBy(F.col("_k").alias(key), "n_frames").agg(
        ((F.max(F.when(holds(low), F.col("_v"))) + F.max(F.when(holds(high), F.col("_v")))) / 2).alias("median_tempo")).select(
        key, "median_tempo", "n_frames")


def top_candidate(cands: DataFrame, key: str, bpm: str = "bpm", weight: str = "weight",
                  pos: str = "pos") -> DataFrame:
    """The best candidate tempo per track: highest weight, ties by the
    lowest candidate position, then the lowest tempo (deterministic).  The
    aggregated rows are narrow: key, weight, position, tempo."""
    order = F.struct(F.col(weight), -F.col(pos), -F.col(bpm))
    return cands.groupBy(key).agg(F.max_by(F.col(bpm), order).alias("top_tempo"),
                                  F.count(F.lit(1)).alias("n_candidates"))


def _pitch(chroma: Column, i: int) -> Column:
    return F.get(chroma, i).cast("double")


def chroma_mode(frames: DataFrame, key: str, chroma: str = "chroma") -> DataFrame:
    """Mean chroma of the major triad classes vs the minor triad classes;
    major when the major mean is at least the minor mean."""
    c = F.col(chroma)
    used = sorted(set(C.CHROMA_MAJOR) | set(C.CHROMA_MINOR))
    agg = frames.groupBy(key).agg(*[F.avg(_pitch(c, i)).alias(f"_c{i}") for i in used],
                                  F.count(F.lit(1)).alias("n_frames"))

    def mean_of(classes):
        s = None
        for i in classes:
            s = F.col(f"_c{i}") if s is None else s + F.col(f"_c{i}")
        return s / F.lit(float(len(classes)))

    maj, minr = mean_of(C.CHROMA_MAJOR), mean_of(C.CHROMA_MINOR)
    return agg.select(key, "n_frames", maj.alias("chroma_major"), minr.alias("chroma_minor"),
                      F.when(maj >= minr, F.lit("Major")).otherwise(F.lit("Minor")).alias("mode"))


def mono_mix(channels: Column) -> Column:
    """Mean over the channel values of one sample (left to right)."""
    total = F.aggregate(channels, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(channels) > 0, total / F.size(channels))
