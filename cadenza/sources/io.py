"""Scans and sinks (SRC-1, SRC-5..9, SNK-1..5).

Paths may be local or any Hadoop file system; nothing is staged on the
driver.  Snapshots are versioned directories: a reader takes the highest
committed version (``_SUCCESS`` present), a writer always writes a new
version, so the path being read is never overwritten.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from ..functions import num, text
from ..operators.common import materialised, one_per_key
from . import documents, ordered

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             row_col: str | None = "_row", multi_line: bool = True) -> DataFrame:
    """Header CSV with doubled-quote escapes.  Only the empty field becomes NULL
    ('NA' stays text).  ``multi_line``: quoted fields may hold line breaks (a
    lyrics column); splits are then cut by the parity of quotes.
    ``row_col``: the row's number from 0 in the order of paths and lines."""
    if multi_line:
        return ordered.read_quoted_csv(spark, path, schema, CSV_OPTIONS, row_col)
    df = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    return ordered.numbered(df, row_col) if row_col else df


def require(df: DataFrame, cols) -> DataFrame:
    from ..operators.common import require_columns
    return require_columns(df, cols)


def _no_file(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return not fs.exists(p)


def read_cache_json_lines(spark: SparkSession, path: str, value_ddl: str = "BPM double, Mode string",
                          key: str = "song_key") -> DataFrame:
    """Read a cache export: one ``{key: {field: value}}`` object per line, so files
    split.  Lines that don't parse are dropped; a missing path is an empty table."""
    schema = f"{key} string, {value_ddl}"
    if _no_file(spark, path):
        return spark.createDataFrame([], schema)
    parsed = spark.read.text(path).select(F.from_json("value", f"map<string, struct<{value_ddl}>>").alias("m"))
    return parsed.select(F.explode("m").alias(key, "v")).select(key, "v.*")


def import_cache_document(spark: SparkSession, path: str, value_ddl: str = "BPM double, Mode string",
                          key: str = "song_key") -> DataFrame:
    """Import JSON documents ``{key: {field: value}, ...}``, one a file, as rows (key, fields...).  A
    document may be read by many tasks, at whatever line ends it has.  A key that repeats keeps its last value in the order
    of paths and places; a value that is no object gives NULL fields.  A missing file, and one
    that isn't a whole JSON object, gives no rows."""
    if _no_file(spark, path):
        return spark.createDataFrame([], f"{key} string, {value_ddl}")
    entries = documents.object_entries(spark, path)
    # the key by a schema that any value fits, as entries whose value is no object keep theirs
    named = entries.select("_path", "_start", "row", F.map_keys(F.from_json("entry", "map<string, string>"))[0].alias(key),
                           F.map_values(F.from_json("entry", f"map<string, struct<{value_ddl}>>"))[0].alias("v"))
    last = one_per_key(named.withColumn("_place", F.struct("_path", "_start", "row")), [key], "_place", last=True)
    return last.select(key, "v.*")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated ``word valence arousal`` lines -> (word,
    valence, arousal).  Blank and '#' lines, lines with fewer than three
    fields and lines whose numbers do not parse are dropped; the word is
    lower-cased; a repeated word keeps its last line in the order of paths and lines."""
    lines = ordered.numbered(spark.read.text(path), "_line")
    s = text.strip("value")
    parts = F.split(s, f"(?U)[{text.WS_CLASS}]+")
    cand = lines.where((s != "") & ~s.startswith("#")).select("_line", parts.alias("p"))
    cand = cand.where(F.size("p") >= 3).select(
        "_line", F.lower(F.get("p", 0)).alias("word"),
        num.coerce_number(F.get("p", 1)).alias("valence"),
        num.coerce_number(F.get("p", 2)).alias("arousal"))
    cand = cand.where(F.col("valence").isNotNull() & F.col("arousal").isNotNull())
    return one_per_key(cand, ["word"], "_line", last=True).select("word", "valence", "arousal")


def count_listed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text list after stripping the whole text: blank lines at
    the start and end do not count, inner blank lines do; empty -> 0."""
    lines = ordered.placed(spark.read.text(path).withColumn("full", text.strip("value") != ""))
    at = F.when(F.col("full"), F.col("_at"))
    splits = lines.groupBy(*ordered.PLACE).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_at"), F.min(at).alias("first"), F.max(at).alias("last"))
    before = ordered.before("n") - F.col("_at")
    placed = materialised(splits.select((before + F.col("first")).alias("first"), (before + F.col("last")).alias("last")), "line-splits")
    return placed.agg(F.coalesce(F.max("last") - F.min("first") + F.lit(1), F.lit(0)).alias("n_lines"))


def read_clips(spark: SparkSession, path: str, min_bytes: int) -> DataFrame:
    """Binary clips at least ``min_bytes`` long (the length filter is
    applied to file metadata before contents are read)."""
    return spark.read.format("binaryFile").load(path).where(F.col("length") >= min_bytes)


# --------------------------------------------------------------------------
# Sinks
# --------------------------------------------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV (a directory of parts; no coalesce to one file); white space stays."""
    df.write.mode(mode).options(header="true", escape='"', quote='"', ignoreLeadingWhiteSpace="false",
                                ignoreTrailingWhiteSpace="false").csv(path)


def write_split(gated: DataFrame, path: str, flag: str = "ready_to_score",
                ok_col: str = "required_ok") -> dict:
    """READY/HOLD split in one pass: one sub-directory per label.  Returns
    the row counts of both sides, observed during the write (no extra job)."""
    obs = Observation("split_counts")
    observed = gated.observe(obs, F.count(F.lit(1)).alias("n_rows"),
                             F.count_if(F.col(ok_col)).alias("n_ready"),
                             F.count_if(~F.col(ok_col)).alias("n_hold"))
    observed.write.mode("overwrite").partitionBy(flag).parquet(path)
    return obs.get


def write_lines_if_any(df: DataFrame, line_col: str, path: str) -> bool:
    """Write one line per row, only when there is at least one row (the look
    for a first row stops at it)."""
    if not df.select(line_col).take(1):
        return False
    df.select(F.col(line_col).cast("string")).write.mode("overwrite").text(path)
    return True


def sanitize_floats(df: DataFrame) -> DataFrame:
    """NaN/+Inf/-Inf -> NULL on every top-level float column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(num.sanitize(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _fs(spark: SparkSession, base: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def snapshot_versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions under ``base`` (``v=N`` with ``_SUCCESS``)."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and name[2:].isdigit():
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def write_snapshot(df: DataFrame, base: str, version: int | None = None) -> str:
    """Write a new snapshot version (floats sanitised); an explicit version
    (e.g. a stream batch id) makes a replay overwrite its own output.

    A new version is written beside the others, then its number is claimed by a file that only one
    writer can create, and the folder renamed: writers at one time get numbers of their own, and a
    reader sees whole snapshots only."""
    spark, root = df.sparkSession, base.rstrip("/")
    if version is not None:
        path = f"{root}/v={version}"
        sanitize_floats(df).write.mode("overwrite").parquet(path)
        return path
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    sanitize_floats(df).write.parquet(staged)
    fs, p, jvm = _fs(spark, root)
    number = max(snapshot_versions(spark, base), default=0) + 1
    while not _claim(fs, jvm.org.apache.hadoop.fs.Path(p, f"_claim-{number}")):
        number += 1
    path = f"{root}/v={number}"
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"can't rename {staged} to {path}")
    return path


def _claim(fs, path) -> bool:
    """Whether this call created the file."""
    try:
        fs.create(path, False).close()
        return True
    except Py4JJavaError as e:
        if fs.exists(path):
            return False
        raise e


def read_snapshot(spark: SparkSession, base: str, schema: str | None = None,
                  max_version: int | None = None) -> DataFrame | None:
    """Latest committed snapshot (at most ``max_version`` when given), or an
    empty frame of ``schema`` (None if no schema is given and nothing is
    committed)."""
    vs = [v for v in snapshot_versions(spark, base) if max_version is None or v <= max_version]
    if vs:
        return spark.read.parquet(f"{base.rstrip('/')}/v={vs[-1]}")
    return spark.createDataFrame([], schema) if schema else None


def export_cache_json_lines(df: DataFrame, key: str, path: str) -> None:
    """One JSON object per key and line: {"key": {...fields, nulls kept}}."""
    fields = [c for c in df.columns if c != key]
    body = F.to_json(F.create_map(F.col(key), F.struct(*fields)), {"ignoreNullFields": "false"})
    sanitize_floats(df).select(body.alias("value")).write.mode("overwrite").text(path)
