"""Resumable incremental enrichment (STR-1).

A file stream over a landing directory, run with ``availableNow``: every file
present is processed once, in micro-batches, and the query stops.  Micro-batch
``k`` is folded against the cache as of batch ``k - 1`` (JOI-6/7/8).  It writes
its rows to ``rows/batch=<k>`` and only the cache entries of its own keys, as
delta ``cache/deltas/v=<k + 1>``; the cache as of a version is the newest entry
of each key up to it.  All outputs are named by the batch, so a batch that is
replayed after a failure overwrites its own output and never reads it; the
stream checkpoint replaces the original every-N-rows cache save, and a second
run over the same input finds nothing new.

Deltas are merged in levels as the run goes on: ``fanout`` of them make a run of
level 1, ``fanout`` runs of level 1 one of level 2, and so on.  A run holds one
entry per key.  So the cache as of any version is a union of fewer than
``fanout`` runs of each level, whatever the number of batches before, and an
entry is rewritten once a level.  Folders are looked up by name, not listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import lookup_join, one_per_key
from ..operators.enrich import enrich_fold
from ..sources.io import _fs, write_snapshot

CACHE_SCHEMA = "song_key string, bpm double, mode string"
FANOUT = 8


def _committed(spark: SparkSession, path: str) -> bool:
    fs, p, jvm = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def _run_path(base: str, level: int, last: int) -> str:
    """Folder of the run of ``level`` whose newest version is ``last``; level 0 are the deltas."""
    return f"{base}/deltas/v={last}" if level == 0 else f"{base}/runs/level={level}/v={last}"


def runs_as_of(spark: SparkSession, base: str, version: int, fanout: int, first: int = 0,
               top: int | None = None) -> list[tuple[int, int]]:
    """The fewest (level, newest version) that cover the versions ``first`` to ``version``, oldest first,
    with no level above ``top``.  A version whose batch was empty has no delta; a run that isn't there (yet)
    is covered by those below it."""
    out, at = [], first
    while at <= version:
        level = 0
        while at % fanout ** (level + 1) == 0 and at + fanout ** (level + 1) - 1 <= version and level != top:
            level += 1
        while level > 0 and not _committed(spark, _run_path(base, level, at + fanout ** level - 1)):
            level -= 1
        last = at + fanout ** level - 1
        if level > 0 or _committed(spark, _run_path(base, 0, last)):
            out.append((level, last))
        at = last + 1
    return out


def _newest(spark: SparkSession, base: str, runs: list[tuple[int, int]], key: str) -> DataFrame:
    frames = [spark.read.parquet(_run_path(base, level, last)).withColumn("_v", F.lit(last)) for level, last in runs]
    if not frames:
        return spark.createDataFrame([], CACHE_SCHEMA)
    entries = frames[0]
    for f in frames[1:]:
        entries = entries.unionByName(f)
    return one_per_key(entries, [key], "_v", last=True).drop("_v") if len(frames) > 1 else entries.drop("_v")


def cache_as_of(spark: SparkSession, base: str, version: int, key: str = "song_key", fanout: int = FANOUT) -> DataFrame:
    """The newest entry of each key in the deltas up to ``version``."""
    return _newest(spark, base, runs_as_of(spark, base, version, fanout), key)


def merge_runs(spark: SparkSession, base: str, version: int, key: str = "song_key", fanout: int = FANOUT) -> list[str]:
    """Write the runs that end with ``version``, one a level, each from those of the level below.
    Writing them again gives the same entries."""
    out, level = [], 1
    while (version + 1) % fanout ** level == 0:
        first = version + 1 - fanout ** level
        parts = runs_as_of(spark, base, version, fanout, first, level - 1)
        if parts:
            path = _run_path(base, level, version)
            _newest(spark, base, parts, key).write.mode("overwrite").parquet(path)
            out.append(path)
        level += 1
    return out


def run_incremental_enrich(spark: SparkSession, stream: DataFrame,
                           prepare: Callable[[DataFrame], DataFrame], providers: DataFrame,
                           work_dir: str, initial_cache: DataFrame | None = None,
                           key: str = "song_key", order: str = "_row", fanout: int = FANOUT) -> dict:
    """Process everything available in ``stream`` and stop.

    ``prepare`` turns a micro-batch into fold input (key, order, own bpm/mode); the
    source's ``maxFilesPerTrigger`` bounds a batch.  Layout under ``work_dir`` (a
    shared folder): checkpoint/, cache/deltas/v=N, cache/runs/level=L/v=N, rows/batch=N.
    ``fanout`` stays the same over all runs on a folder.
    Returns the paths and the batch count."""
    base = work_dir.rstrip("/")
    cache_base, rows_base = f"{base}/cache", f"{base}/rows"
    if initial_cache is not None and not _committed(spark, _run_path(cache_base, 0, 0)):
        write_snapshot(initial_cache.select(key, "bpm", "mode"), f"{cache_base}/deltas", version=0)
    batches = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                merge_runs(spark, cache_base, batch_id + 1, key, fanout)
                return
            tracks = prepare(batch)
            keys = tracks.select(key).distinct()
            cache = cache_as_of(spark, cache_base, batch_id, key, fanout)
            mine = lookup_join(cache, keys, [key], "left_semi")
            rows, snap = enrich_fold(tracks, providers, mine, key=key, order=order)
            rows.write.mode("overwrite").parquet(f"{rows_base}/batch={batch_id}")
            write_snapshot(snap, f"{cache_base}/deltas", version=batch_id + 1)
            merge_runs(spark, cache_base, batch_id + 1, key, fanout)
            batches.append(batch_id)
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return {"rows": rows_base, "cache": cache_base, "batches": len(batches)}
