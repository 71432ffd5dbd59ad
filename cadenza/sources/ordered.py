"""Rows of files in file order, whatever tasks read them.

Spark packs splits of files into tasks by size, so neither task numbers nor ids made from them
follow the files.  What does is the path, the place of the split in its file, and the position
inside the split.  One row for each split is enough to number all rows: its rows are counted and the
counts added up in that order.  No row is sorted or moved for it.

Quoted CSV fields may hold line ends, so a split can begin inside a field.  Quotes tell: a line begins
inside a field if the quotes before it in its file are odd.  A first pass counts, for each split, the
quotes and the records that begin in it for either state at its start; exclusive-or over the splits of a file
gives the states, and a second pass reads all splits at once.  Records that go on over a split's end are
put together from their pieces.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.common import materialised

PLACE = ("_path", "_start")        # of a split


def placed(df: DataFrame) -> DataFrame:
    """``df``, a plain scan of files, with _path and _start of its split and _at, which grows inside the split."""
    return df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_at"))


def before(col: str, *parts: str):
    """The sum of ``col`` over the earlier splits; one row a split, so the window is short."""
    w = Window.partitionBy(*parts) if parts else Window.partitionBy()
    return F.coalesce(F.sum(col).over(w.orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))


def numbered(df: DataFrame, row_col: str) -> DataFrame:
    """``df``, a plain scan of files, with the number of each row from 0 in the order of paths and lines."""
    rows = placed(df)
    splits = rows.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    splits = materialised(splits.select(*PLACE, "_first", before("n").alias("_before")), "splits")
    return (rows.join(splits, list(PLACE))
            .select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(row_col)))


# --- CSV with line ends in fields ----------------------------------------------------------

def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, quotes, split key): lines end at \\n alone, so that fields keep their \\r."""
    lines = spark.read.text(path, lineSep="\n").select(
        "value", (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    return lines.select("value", "quotes", "_path", "_start", F.xxhash64("_path").alias("_file"))


_BLANK = ("", "\r")


def _count(batches):
    """Of each split: whether its quotes are odd, and the records beginning in it if it begins outside or
    inside a field.  Blank lines between records are none."""
    key, odd, n = None, 0, [0, 0]

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip([*key, odd, *n], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            names=["_file", "_start", "odd", "outside", "inside"])

    for b in batches:
        for file, start, quotes, blank in zip(*(b.column(k).to_pylist() for k in range(4))):
            if (file, start) != key:
                if key is not None:
                    yield done()
                key, odd, n = (file, start), 0, [0, 0]
            if not blank:
                n[odd] += 1
            odd ^= quotes & 1
    if key is not None:
        yield done()


def _records(states: dict):
    """Lines to records: (row, value, _file, _start, piece).  ``piece`` is 0 for a whole record, 1 for the
    beginning of one that the split doesn't end, 2 for lines that go on with it."""

    def run(batches):
        key, open_, held, piece, row = None, 0, [], 0, 0
        known = states.value
        rows, values, files, starts, pieces = [], [], [], [], []

        def add(kind):
            rows.append(row if kind < 2 else -1)
            values.append("\n".join(held))
            files.append(key[0])
            starts.append(key[1])
            pieces.append(kind)

        def batch():
            out = pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(values, pa.large_string()).cast(pa.string()), pa.array(files, pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(pieces, pa.int32())], names=["row", "value", "_file", "_start", "piece"])
            for x in (rows, values, files, starts, pieces):
                x.clear()
            return out

        def close():
            if held:
                add(2 if piece == 2 else 1)

        for b in batches:
            for file, start, quotes, value in zip(*(b.column(k).to_pylist() for k in range(4))):
                if (file, start) != key:
                    if key is not None:
                        close()
                    key = file, start
                    open_, row = known[key]
                    held, piece = [], 2 if open_ else 0
                if not held and piece == 0 and not open_ and value in _BLANK and not quotes & 1:
                    continue
                held.append(value)
                open_ ^= quotes & 1
                if not open_:
                    held[-1] = held[-1].removesuffix("\r")
                    add(piece)
                    row += piece == 0
                    held, piece = [], 0
            if rows:
                yield batch()
        if key is not None:
            close()
            yield batch()

    return run


def put_together(found: DataFrame, sep: str) -> DataFrame:
    """(row, value, _file, _start) of records found in splits: whole ones (``piece`` 0) as they are, those begun in one
    split (1) joined by ``sep`` with what later splits go on with (2)."""
    whole = found.where("piece = 0").select("row", "value", "_file", "_start")
    # pieces: at most two a split; which beginning a later piece belongs to is found without the texts
    parts = found.where("piece > 0")
    marks = parts.select("_file", "_start", "piece", "row")
    w = Window.partitionBy("_file").orderBy("_start", F.desc("piece")).rowsBetween(Window.unboundedPreceding, 0)
    owner = marks.withColumn("o", F.last(F.when(F.col("piece") == 1, F.struct("row", F.col("_start").alias("at"))), True).over(w))
    joined = (parts.select("_file", "_start", "piece", "value")
              .join(owner.select("_file", "_start", "piece", F.col("o.row").alias("row"), F.col("o.at").alias("at")), ["_file", "_start", "piece"])
              .groupBy("_file", "at", "row").agg(F.array_sort(F.collect_list(F.struct("_start", F.negative("piece").alias("k"), "value"))).alias("p"))
              .select("row", F.array_join(F.transform("p", lambda x: x["value"]), sep).alias("value"), "_file", F.col("at").alias("_start")))
    return whole.unionByName(joined)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(row, value): the records of CSV files without their headers, numbered from 0 in file order.

    Any split of a file can be read by any task.  Quotes stand only around whole fields and doubled inside
    them, as RFC 4180 has it; a field that is open at the end of its file ends there."""
    lines = _lines(spark, path)
    blank = F.col("value").isin(*_BLANK)
    # one row a split; the driver keeps as much of each of them already
    counts = lines.select("_file", "_start", "quotes", blank.alias("blank")).mapInArrow(
        _count, "_file bigint, _start bigint, odd int, outside bigint, inside bigint")
    names = lines.select("_path", "_file").distinct()
    splits = materialised(counts.join(F.broadcast(names), "_file"), "csv-splits")
    states = splits.withColumn("open", (before("odd", "_path") % 2).cast("int"))
    states = states.withColumn("n", F.when(F.col("open") == 1, F.col("inside")).otherwise(F.col("outside")))
    # each file's first record is its header
    first = F.row_number().over(Window.partitionBy("_path", F.col("n") > 0).orderBy("_start")) == 1
    states = states.withColumn("rows", F.col("n") - F.when((F.col("n") > 0) & first, 1).otherwise(0))
    states = states.withColumn("row", before("rows") - (F.col("rows") < F.col("n")).cast("int"))
    states = states.withColumn("header", F.when(F.col("rows") < F.col("n"), F.col("row")))
    states = materialised(states.select("_path", "_file", "_start", "open", "row", "header"), "csv-states")
    table, paths = {}, {}
    for r in states.collect():
        if paths.setdefault(r["_file"], r["_path"]) != r["_path"]:
            raise ValueError("two paths with one hash")
        table[r["_file"], r["_start"]] = r["open"], r["row"]
    shipped = spark.sparkContext.broadcast(table)
    found = lines.select("_file", "_start", "quotes", "value").mapInArrow(
        _records(shipped), "row bigint, value string, _file bigint, _start bigint, piece int")
    found = materialised(found, "csv-records")
    headers = states.where("header is not null").select("_file", "_start", F.col("header").alias("row"))
    found = put_together(found, "\n")
    return found.join(F.broadcast(headers), ["_file", "_start", "row"], "left_anti").select("row", "value")


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str, options: dict, row_col: str | None) -> DataFrame:
    """The records of CSV files parsed by ``schema``."""
    if not isinstance(schema, str):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opts = {k: v for k, v in options.items() if k != "header"}
    parsed = records(spark, path).select("row", F.from_csv("value", schema, opts).alias("_r"))
    return parsed.select("_r.*", *([F.col("row").alias(row_col)] if row_col else []))
