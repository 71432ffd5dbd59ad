"""Distributed global row numbering (WIN-3/WIN-4, ORD-1).

``row_number() OVER (ORDER BY ...)`` without a partition pulls every row
into one task.  Instead: range-partition on the order, sort inside each
partition, take the in-partition position from
``monotonically_increasing_id`` (partition id in the upper bits, position in
the lower 33), count rows per partition, turn the counts into offsets over a
table of at most ``num_partitions`` rows, and add the offset back through a
broadcast of that bounded table.  The order must be total (break ties with a
unique column).  The tagged frame is checkpointed (reliable, shared
folder) so the counts and the numbering read the same materialised
positions: one range shuffle, and no dependence on two shuffles agreeing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    tagged = ordered.withColumns({"_rk_pid": F.shiftright(mid, 33),
                                  "_rk_pos": mid.bitwiseAND(F.lit(_LOW_BITS))})
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_rk_pid").agg(F.count(F.lit(1)).alias("_rk_n"))
    w = Window.orderBy("_rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rk_pid", F.coalesce(F.sum("_rk_n").over(w), F.lit(0)).alias("_rk_off"))
    out = tagged.join(F.broadcast(offsets), "_rk_pid")
    return (out.withColumn(name, out["_rk_off"] + out["_rk_pos"] + F.lit(1))
            .drop("_rk_pid", "_rk_pos", "_rk_off"))
