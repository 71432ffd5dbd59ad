"""One JSON object read by many tasks.

A file is read as its pieces between commas, which Spark cuts into splits at any comma.  Whether a comma
parts two entries of the object depends on what stands before it: whether it is inside a string, and how many
brackets are open.  Each piece is reduced to what it does to either state at its start (JVM-side), and a first pass adds
that up over the pieces of a split.  Summed over the splits of a file it gives each split's state; a
second pass then cuts all splits into entries at once.  Entries that go on over a split's end are put together from their
parts.  A backslash never stands before a comma in JSON, so no escape reaches over a piece's end.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import materialised
from .ordered import before, put_together

_WS = " \t\r\n﻿"


def _brackets(col):
    """Brackets opened less brackets closed."""
    return (F.length(F.translate(col, "}]", "")) - F.length(F.translate(col, "{[", ""))).cast("int")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(value, odd, outside, inside, _path, _start, _file): ``odd`` if the piece's quotes are; its change of
    depth if it starts outside or inside a string."""
    raw = spark.read.text(path, lineSep=",").select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    runs = raw.select("*", F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"').alias("_runs"))
    take = lambda k: F.array_join(F.filter("_runs", lambda _, i: i % 2 == k), "")
    return runs.select("value", (1 - F.size("_runs") % 2).cast("int").alias("odd"), _brackets(take(0)).alias("outside"),
                       _brackets(take(1)).alias("inside"), "_path", "_start", F.xxhash64("_path").alias("_file"))


def _sum_up(batches):
    """Of each split: whether its quotes are odd, and its change of depth if it starts outside or inside a string."""
    key, odd, depth = None, 0, [0, 0]

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip([*key, odd, *depth], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            names=["_file", "_start", "odd", "outside", "inside"])

    for b in batches:
        for file, start, quotes, *change in zip(*(b.column(k).to_pylist() for k in range(5))):
            if (file, start) != key:
                if key is not None:
                    yield done()
                key, odd, depth = (file, start), 0, [0, 0]
            depth[0] += change[odd]
            depth[1] += change[1 - odd]
            odd ^= quotes
    if key is not None:
        yield done()


def _entries(states: dict):
    """Pieces to entries: (row, value, _file, _start, piece); ``row`` counts the entries that begin in the split,
    ``piece`` is 0 for a whole entry, 1 for the beginning of one that the split doesn't end, 2 for what goes on with it."""

    def run(batches):
        key, inside, depth, held, piece, row = None, 0, 0, [], 0, 0
        known = states.value
        out = []

        def add(kind):
            out.append((row if kind < 2 else -1, ",".join(held), *key, kind))

        def batch():
            got = pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()))],
                names=["row", "value", "_file", "_start", "piece"])
            out.clear()
            return got

        def close():
            if held:
                add(2 if piece == 2 else 1)

        for b in batches:
            for file, start, quotes, outside, within, value in zip(*(b.column(k).to_pylist() for k in range(6))):
                if (file, start) != key:
                    if key is not None:
                        close()
                    key, row, held = (file, start), 0, []
                    inside, depth = known[key]
                    piece = 0 if start == 0 or (depth == 1 and not inside) else 2
                held.append(value)
                depth += within if inside else outside
                inside ^= quotes
                if depth == 1 and not inside:
                    add(piece)
                    row += piece == 0
                    held, piece = [], 0
            if out:
                yield batch()
        if key is not None:
            close()
            if out:
                yield batch()

    return run


def object_entries(spark: SparkSession, path: str) -> DataFrame:
    """(_path, _start, row, entry): the entries of the JSON objects at ``path``, one object a file, each as an object
    of one entry.  ``_path, _start, row`` is the place of an entry.  Any split of a file can be read by any task.

    A file that isn't one whole JSON object gives no entries.  What is held in one place is one entry, and on the driver
    one row a split, as Spark's own list of splits."""
    pieces = _pieces(spark, path)
    sums = pieces.select("_file", "_start", "odd", "outside", "inside").mapInArrow(
        _sum_up, "_file bigint, _start bigint, odd int, outside bigint, inside bigint")
    names = pieces.select("_path", "_file").distinct()
    splits = materialised(sums.join(F.broadcast(names), "_file"), "json-splits")
    states = splits.withColumn("open", (before("odd", "_path") % 2).cast("int"))
    states = states.withColumn("change", F.when(F.col("open") == 1, F.col("inside")).otherwise(F.col("outside")))
    states = states.withColumn("depth", before("change", "_path"))
    table, paths = {}, {}
    for r in states.select("_path", "_file", "_start", "open", "depth").collect():
        if paths.setdefault(r["_file"], r["_path"]) != r["_path"]:
            raise ValueError("two paths with one hash")
        table[r["_file"], r["_start"]] = r["open"], r["depth"]
    shipped = spark.sparkContext.broadcast(table)
    found = pieces.select("_file", "_start", "odd", "outside", "inside", "value").mapInArrow(
        _entries(shipped), "row bigint, value string, _file bigint, _start bigint, piece int")
    found = put_together(materialised(found, "json-entries"), ",")
    whole = states.groupBy("_file", "_path").agg((F.sum("odd") % 2 == 0).alias("closed"), F.sum("change").alias("depth"))
    # one row a file on the small sides of these joins, which the driver lists already
    found = found.join(F.broadcast(whole.where("closed and depth = 0").select("_file", "_path")), "_file")
    # the object's own brackets stand in its first and its last entry
    place = F.struct("_start", "row")
    last = found.groupBy("_file").agg(F.max(place).alias("_last"))
    found = found.join(F.broadcast(last), "_file")
    first_, last_ = (F.col("_start") == 0) & (F.col("row") == 0), place == F.col("_last")
    v = F.btrim("value", F.lit(_WS))
    body = found.select("_file", "_path", "_start", "row", first_.alias("_f"), last_.alias("_l"),
                        ((~first_ | v.startswith("{")) & (~last_ | v.endswith("}"))).alias("_ok"),
                        F.btrim(F.substr(v, F.when(first_, 2).otherwise(1),
                                         F.length(v) - first_.cast("int") - last_.cast("int")), F.lit(_WS)).alias("body"))
    body = body.where(~(F.col("_ok") & F.col("_f") & F.col("_l") & (F.col("body") == "")))           # {}
    entry = F.concat(F.lit("{"), F.col("body"), F.lit("}"))
    # a parser stops at the end of a value; "end" is only read if the entry is one value and nothing else
    checked = F.try_variant_get(F.try_parse_json(F.concat(F.lit('{"entry": '), entry, F.lit(', "end": 0}'))), "$.end", "int")
    body = body.select("_file", "_path", "_start", "row", entry.alias("entry"),
                       (F.col("_ok") & (F.col("body") != "") & checked.isNotNull()).alias("_ok"))
    broken = body.where(~F.col("_ok")).select("_file").distinct()
    return body.join(F.broadcast(broken), "_file", "left_anti").select("_path", "_start", "row", "entry")
