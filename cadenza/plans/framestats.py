"""Frame-statistics plans: events are tempo frames per user (= track),
lineitem rows are tempo candidates per order, embeddings are chroma frames
per label."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.frames import chroma_mode, median_tempo, mono_mix, top_candidate
from .base import load, round_doubles


def q_tempo_median(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(F.col("user_id").alias("track_id"),
                                              F.col("value").alias("tempo"))
    return round_doubles(median_tempo(ev, "track_id"))


def q_tempo_top(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").alias("pos"),
        F.col("l_quantity").alias("bpm"), F.col("l_discount").alias("weight"))
    return round_doubles(top_candidate(li, "track_id"))


def q_chroma_mode(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings").select(F.col("label").alias("track_id"),
                                                   F.col("embedding").alias("chroma"))
    return round_doubles(chroma_mode(emb, "track_id"))


def q_mono_mix(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings")
    return round_doubles(emb.select("vec_id", mono_mix(F.col("embedding")).alias("mono")))


ORACLE = {
    "tempo_median": """SELECT user_id AS track_id, round(median(value), 6) AS median_tempo, count(value) AS n_frames
        FROM events GROUP BY user_id""",
    "tempo_top": """SELECT track_id, round(bpm, 6) AS top_tempo, n AS n_candidates FROM (
          SELECT l_orderkey AS track_id, l_quantity AS bpm, count(*) OVER (PARTITION BY l_orderkey) AS n,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber, l_quantity) AS rn
          FROM lineitem) WHERE rn = 1""",
    "chroma_mode": """WITH a AS (
          SELECT label AS track_id, count(*) AS n_frames,
                 avg(CAST(embedding[1] AS DOUBLE)) AS c0, avg(CAST(embedding[4] AS DOUBLE)) AS c3,
                 avg(CAST(embedding[5] AS DOUBLE)) AS c4, avg(CAST(embedding[8] AS DOUBLE)) AS c7
          FROM embeddings GROUP BY label)
        SELECT track_id, n_frames, round((c0 + c4 + c7) / 3.0, 6) AS chroma_major,
               round((c0 + c3 + c7) / 3.0, 6) AS chroma_minor,
               CASE WHEN (c0 + c4 + c7) / 3.0 >= (c0 + c3 + c7) / 3.0 THEN 'Major' ELSE 'Minor' END AS mode
        FROM a""",
    "mono_mix": """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding), 6) AS mono
        FROM embeddings""",
}

QUERIES = {
    "tempo_median": q_tempo_median,
    "tempo_top": q_tempo_top,
    "chroma_mode": q_chroma_mode,
    "mono_mix": q_mono_mix,
}
