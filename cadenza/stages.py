"""Stage-level API: one function per stage of the original pipeline, each a
composition of the operators (no new semantics).  Keys follow the original:
enrichment by ``enrich_key``, lyrics by ``lyrics_key``, answers by
``answer_key`` (case kept), merge-back by lower/strip of title and artist.

Track tables use snake_case columns: ``_row, title, artist, track_id,
source_link, bpm, mode, valence, lyrics, lyric_valence, lyric_arousal, ...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import config as C
from .functions import text
from .operators.answers import count_updates, fill_context, infer_answers, work_set
from .operators.common import lookup_join
from .operators.enrich import enrich_fold
from .operators.gate import gate_tracks, split_ready
from .operators.merge import merge_back
from .operators.quality import classify_lyrics, flagged_rows, status_counts
from .operators.resolve import failed_ids, features_with_fallback, one_lookup_row, resolve_tracks, upsert_cache
from .operators.score import rank_by_score, score_tracks
from .operators.sentiment import lyric_sentiment, lyrics_lookup


def resolve_stage(songs: DataFrame, catalog: DataFrame, rank: list[Column],
                  features: DataFrame, analysis: DataFrame) -> dict:
    """Songs -> catalogue hits with features (primary, else fallback),
    plus the not-found list and the ids with no features."""
    hits, not_found = resolve_tracks(songs, catalog, rank)
    tracks = features_with_fallback(hits, features, analysis)
    return {"tracks": tracks, "not_found": not_found,
            "failed_ids": failed_ids(hits, features, analysis)}


def enrich_stage(tracks: DataFrame, providers: DataFrame, cache: DataFrame | None = None,
                 order: str = "_row") -> tuple[DataFrame, DataFrame]:
    """Fill BPM/Mode (own -> cache -> providers, in-batch reuse); returns
    (enriched tracks, cache snapshot to write)."""
    keyed = tracks.withColumn("song_key", text.enrich_key("title", "artist"))
    rows, snap = enrich_fold(keyed, providers, cache, key="song_key", order=order)
    return rows.drop("song_key"), snap


def lyrics_stage(tracks: DataFrame, lexicon: DataFrame, lyrics_source: DataFrame | None = None,
                 lyrics_cache: DataFrame | None = None, sentiment_cache: DataFrame | None = None,
                 scores: DataFrame | None = None) -> DataFrame:
    """Attach lyrics (cache, else cleaned fetch, else '') and lyric valence /
    arousal (cached numeric pair, else lexicon, else fallback scorers).
    Side tables are keyed by ``lyrics_key``; ``scores`` by ``_row``."""
    keyed = tracks.withColumn("lyrics_key", text.lyrics_key("title", "artist"))
    with_lyrics = lyrics_lookup(keyed, "lyrics_key", lyrics_cache, lyrics_source)
    cache = None
    if sentiment_cache is not None:
        cache = (lookup_join(keyed.select("_row", "lyrics_key"), one_lookup_row(sentiment_cache, "lyrics_key"),
                             ["lyrics_key"], "inner").drop("lyrics_key"))
    sent = lyric_sentiment(with_lyrics.select("_row", "lyrics"), "_row", "lyrics", lexicon,
                           scores=scores, cache=cache)
    return with_lyrics.drop("lyrics_key").join(sent, "_row", "left")


def context_stage(tracks: DataFrame, answers: DataFrame, model=None, order: str = "_row") -> dict:
    """Fill listening context / contraindications for rows that need it, from
    stored answers or the model (once per new key; None: the native rule).  Both
    outputs of an answered row are overwritten; ``failures`` stay pending."""
    todo = work_set(tracks).withColumn("answer_key", text.answer_key("title", "artist"))
    filled, snapshot, failures = infer_answers(todo, answers, order, model=model)
    return {"tracks": fill_context(tracks, filled, order), "answers": snapshot, "failures": failures,
            "updates": count_updates(filled)}


def merge_stage(songs: DataFrame, final: DataFrame, run_date: str) -> DataFrame:
    """Results merged back onto the original list (first duplicate wins),
    in input order."""
    return merge_back(songs, final, ("title", "artist"), run_date=run_date).orderBy("_row")


def gate_stage(tracks: DataFrame, run_date: str) -> dict:
    """Clean, flag and split into READY / HOLD."""
    gated = gate_tracks(tracks, run_date)
    ready, needs = split_ready(gated)
    return {"gated": gated, "ready": ready, "needs": needs}


def quality_stage(ready: DataFrame, cfg: C.LyricStatusConfig = C.LyricStatusConfig()) -> dict:
    """Lyric status per row, value counts and the flagged report."""
    classified = classify_lyrics(ready, "lyrics", cfg)
    return {"classified": classified, "counts": status_counts(classified),
            "report": flagged_rows(classified)}


def score_stage(ready: DataFrame, cfg: C.ScoreConfig = C.ScoreConfig()) -> DataFrame:
    """Scores, weights, total, grade and rank (best first, ties by input order)."""
    return rank_by_score(score_tracks(ready, cfg), tie_col="_row")


def lyrics_cache_snapshot(tracks: DataFrame, old_cache: DataFrame | None = None) -> DataFrame:
    """The lyrics/sentiment cache after a lyrics stage (JOI-13): one entry per
    ``lyrics_key`` with the lyrics and the valence/arousal the last row of
    that key produced (NULLs stored too); keys only in ``old_cache`` kept."""
    new = tracks.select(text.lyrics_key("title", "artist").alias("lyrics_key"), "lyrics",
                        F.col("lyric_valence").alias("valence"), F.col("lyric_arousal").alias("arousal"), "_row")
    if old_cache is None:
        old_cache = tracks.sparkSession.createDataFrame(
            [], "lyrics_key string, lyrics string, valence double, arousal double")
    return upsert_cache(old_cache.select("lyrics_key", "lyrics", "valence", "arousal"), new, "lyrics_key", "_row")
