"""Streamed plan: incremental enrichment over the part table, which lands piece by
piece in row order; the stream is resumed after each landing (same inputs as the
fold plan, so its oracle is the fold's)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_path
from ..streaming.incremental import run_incremental_enrich
from .base import load, round_doubles
from .enrichment import ORACLE as FOLD_ORACLE
from .enrichment import fold_inputs


LANDINGS = 3
FANOUT = 2


def q_incremental_enrich(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    top = part.agg(F.max("p_partkey").alias("n")).first()["n"] or 0
    piece = F.least(F.floor(F.col("p_partkey") * LANDINGS / (top + 1)), F.lit(LANDINGS - 1))
    landing, work = shared_path(spark, "incremental_landing"), shared_path(spark, "incremental_enrich")
    _, providers, cache = fold_inputs(spark, sf_dir)

    def prepare(batch):
        size = F.col("p_size")
        return batch.select(
            F.col("p_partkey").alias("_row"), "p_partkey", F.lower("p_name").alias("song_key"),
            F.when(size % 3 == 0, (F.lit(40) + F.lit(2) * size).cast("double")).alias("bpm"),
            F.when(size % 4 == 0, F.when(F.col("p_type").isin("STANDARD", "PROMO"), F.lit("Major"))
                   .otherwise(F.lit("Minor"))).alias("mode"))

    for k in range(LANDINGS):
        # as many files as tasks; all files of a landing are one micro-batch
        part.where(piece == k).repartition(F.col("p_partkey")).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(part.schema).parquet(landing)
        out = run_incremental_enrich(spark, stream, prepare, providers, work, initial_cache=cache, fanout=FANOUT)
    rows = spark.read.parquet(out["rows"])
    return round_doubles(rows.select("p_partkey", "song_key", "bpm", "mode", "bpm_source", "mode_source"))


ORACLE = {"incremental_enrich": FOLD_ORACLE["enrich_fold"]}

QUERIES = {
    "incremental_enrich": q_incremental_enrich,
}
