"""Running sums and last values before a row of its key, with no window longer than ``chunk_rows``.

Rows are numbered over all keys, so a chunk of numbers holds ``chunk_rows`` rows at most, whatever
the key.  A window runs inside (key, chunk); one summary row for each (key, chunk) then takes the row's
place, and the same is done again with the chunks as numbers, until the numbers of one level fit in a
chunk.  A key that holds all of 10^12 rows takes three levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import TUNING
from .common import materialised
from .rank import global_row_number


def before(df: DataFrame, key: str, order: str, outs: dict[str, tuple[str, str]],
           chunk_rows: int | None = None) -> DataFrame:
    """``df`` with, for each entry {out: (kind, column)}, a value over the rows of the same key with a smaller
    ``order`` (unique within the key): the "last" one that isn't NULL, or their "sum" (0 without rows).
    A NULL key is a key."""
    size = max(2, chunk_rows or TUNING.scan_chunk_rows)
    rows = global_row_number(df, [F.col(key), F.col(order)], "_pos")
    top = rows.agg(F.max("_pos")).first()[0]
    return _level(rows, key, outs, size, top or 0).drop("_pos")


def _level(rows: DataFrame, key: str, outs: dict, size: int, top: int) -> DataFrame:
    """``outs`` of rows whose ``_pos`` is ``top`` at most."""
    chunked = rows.withColumn("_chunk", F.floor(F.col("_pos") / F.lit(size)))
    several = top >= size
    if several:         # a partitioning by the key alone would put a hot key's rows into one task
        chunked = chunked.repartition(key, "_chunk")
    within = Window.partitionBy(key, "_chunk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    inner = {o: F.last(c, ignorenulls=True).over(within) if kind == "last" else F.coalesce(F.sum(c).over(within), F.lit(0))
             for o, (kind, c) in outs.items()}
    if not several:
        return chunked.withColumns(inner).drop("_chunk")
    chunked = chunked.withColumns({f"_in_{o}": e for o, e in inner.items()})
    summary = chunked.groupBy(key, "_chunk").agg(*[
        (F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_pos"))) if kind == "last" else F.sum(c)).alias(f"_sum_{o}")
        for o, (kind, c) in outs.items()])
    summary = materialised(summary.withColumnRenamed("_chunk", "_pos"), "scan")      # read twice by the next level
    carry = _level(summary, key,
                   {f"_cr_{o}": (kind, f"_sum_{o}") for o, (kind, _) in outs.items()}, size, top // size)
    carry = carry.select(F.col(key).alias("_ck"), F.col("_pos").alias("_cc"), *(f"_cr_{o}" for o in outs))
    out = chunked.join(carry, chunked[key].eqNullSafe(F.col("_ck")) & (chunked["_chunk"] == F.col("_cc")), "left")
    both = {o: F.coalesce(f"_in_{o}", f"_cr_{o}") if kind == "last" else F.col(f"_in_{o}") + F.coalesce(f"_cr_{o}", F.lit(0))
            for o, (kind, _) in outs.items()}
    return out.withColumns(both).drop("_chunk", "_ck", "_cc", *(f"_in_{o}" for o in outs), *(f"_cr_{o}" for o in outs))
