"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of ``edges`` (a, b): root is the least id of its component.

    Each round links the larger neighbours of a vertex to its least neighbour (large star) and
    then the smaller ones and the vertex itself (small star); rounds stop when nothing changes,
    after about log(vertices) of them.  Minima are pre-aggregated, so a vertex with very many
    edges is no bottleneck; each round is stored in the shared folder.  NULLs and loops are
    left out; no edges give no rows.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e, mark = stored(e, "components"), None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "components")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
