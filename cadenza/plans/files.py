"""Round trips through files in the shared folder: CSV with multi-line fields, JSON-lines
cache, lexicon text, line lists, split write, binary scan; and the frame helpers around them
(schema report, header alias, required columns, dense index, NaN, payload parsers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import num, payload, text
from ..operators.common import ensure_columns, rename_if_absent, require_columns, schema_report
from ..operators.merge import restore_order
from ..operators.rank import global_row_number
from ..session import shared_path
from ..sources import io
from .base import load, round_doubles
from .gating import _gated


# --- sources and sinks -----------------------------------------------------------------

def _in_order(df, key):
    """Range-partitioned and sorted, so that the files written are in order of ``key``: many, of unequal size."""
    parts = max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(parts, key).sortWithinPartitions(key)


def q_csv_roundtrip(spark, sf_dir):
    """Documents written as CSV (line breaks, quotes, NULLs) in files in order and read back with their row numbers."""
    path = shared_path(spark, "csv")
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('say "hi", '), "text").alias("text"), F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"))
    io.write_csv(_in_order(docs, "doc_id"), path)
    return io.read_csv(spark, path, "doc_id bigint, text string, lang string")


def q_csv_plain_scan(spark, sf_dir):
    """A table without line breaks, written in files in order and read as CSV with its row numbers."""
    path = shared_path(spark, "csv")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    io.write_csv(_in_order(part, "p_partkey"), path)
    back = io.read_csv(spark, path, "p_partkey bigint, p_name string, p_retailprice double", multi_line=False)
    return round_doubles(back)


def _cache_rows(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select(F.concat("p_name", F.lit("|||"), F.col("p_partkey").cast("string")).alias("song_key"),
                       F.when(F.col("p_size") % 5 == 0, F.lit(float("nan"))).when(F.col("p_size") % 5 != 1, F.col("p_retailprice")).alias("BPM"),
                       F.when(F.col("p_size") % 3 == 0, F.lit('a "b"')).when(F.col("p_size") % 3 == 1, F.lit("Minor")).alias("Mode"))


def q_cache_roundtrip(spark, sf_dir):
    """Cache entries exported as JSON lines and read back, every key."""
    path = shared_path(spark, "cache-lines")
    io.export_cache_json_lines(_cache_rows(spark, sf_dir), "song_key", path)
    return round_doubles(io.read_cache_json_lines(spark, path))


def q_cache_document(spark, sf_dir):
    """The cache as foreign JSON documents of a thousand keys, a file each, imported by many tasks."""
    path = shared_path(spark, "cache-document")
    rows = load(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / 1000).alias("doc"),
        F.struct(F.concat("p_name", F.lit("|||"), F.col("p_partkey").cast("string")).alias("k"),
                 F.struct(F.col("p_retailprice").alias("BPM"), F.lit("Major").alias("Mode")).alias("v")).alias("e"))
    docs = rows.groupBy("doc").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list("e")))).alias("value"))     # 1,000 keys a document
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return round_doubles(io.import_cache_document(spark, path))


def q_lexicon_file(spark, sf_dir):
    """Lexicon lines with comments, short and unparsable lines and repeated words."""
    path = shared_path(spark, "lexicon")
    part = load(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    line = (F.when(size % 11 == 0, F.lit("# comment 1 2")).when(size % 11 == 1, F.lit("   "))
            .when(size % 11 == 2, F.concat(F.lit("short"), key, F.lit(" 0.5"))).when(size % 11 == 3, F.concat(F.lit("bad"), key, F.lit(" x 0.5")))
            .otherwise(F.concat(F.lit(" Word"), (F.col("p_partkey") % 500).cast("string"), F.lit("\t"),
                                (size.cast("double") / 100).cast("string"), F.lit("  "), key, F.lit("  extra"))))
    _in_order(part, "p_partkey").select(line.alias("value")).write.text(path)       # many files; the last line of a word counts
    return round_doubles(io.read_lexicon(spark, path))


def q_reject_list(spark, sf_dir):
    """The not-found lines written as a text list, and what is read back from it."""
    path = shared_path(spark, "rejects")
    part = load(spark, sf_dir, "part").where(F.col("p_size") % 4 == 0)
    lines = part.select(F.concat_ws(" - ", "p_name", "p_brand").alias("line"))
    wrote = io.write_lines_if_any(lines, "line", path)
    empty = io.write_lines_if_any(lines.where("false"), "line", path + "-none")
    back = spark.read.text(path) if wrote else spark.createDataFrame([], "value string")
    return back.select(F.col("value").alias("line"), F.lit(empty).alias("empty_written"))


def q_listed_lines(spark, sf_dir):
    """Lines of a list with blank ones at both ends and inside."""
    path = shared_path(spark, "lines")
    part = load(spark, sf_dir, "part")
    top = part.agg(F.max("p_partkey")).first()[0] or 0
    inner = F.col("p_partkey").between(3, top - 2) & (F.col("p_size") % 5 != 0)
    _in_order(part, "p_partkey").select(F.when(inner, F.col("p_name")).otherwise(F.lit("  ")).alias("value")).write.text(path)
    return io.count_listed_lines(spark, path)


def q_split_write(spark, sf_dir):
    """The gated tracks written as READY / HOLD folders: rows of each, as observed and as read."""
    path = shared_path(spark, "split")
    seen = io.write_split(_gated(spark, sf_dir), path)
    back = spark.read.parquet(path).groupBy("ready_to_score").agg(F.count(F.lit(1)).alias("n_rows"))
    observed = F.when(F.col("ready_to_score") == C.READY_LABEL, F.lit(seen["n_ready"])).otherwise(F.lit(seen["n_hold"]))
    return back.select("ready_to_score", "n_rows", observed.cast("bigint").alias("n_observed"))


_CLIP_CONVS = 50


def q_clip_scan(spark, sf_dir):
    """The conversations as files by role and block of conversations, found again by the binary scan if large enough."""
    path = shared_path(spark, "clips")
    conv = load(spark, sf_dir, "conversations")
    rows = conv.select(F.concat(F.col("role"), F.floor(F.col("conv_id") / _CLIP_CONVS)).alias("clip"), "text")
    rows.select("clip", F.regexp_replace("text", "\\s", " ").alias("value")).repartition("clip").write.partitionBy("clip").text(path)
    clips = io.read_clips(spark, path, C.MIN_CLIP_BYTES)
    return clips.groupBy(F.regexp_extract("path", "clip=([^/]+)", 1).alias("clip")).agg(F.sum("length").alias("n_bytes"))


# --- frame helpers ---------------------------------------------------------------------

def q_schema_report(spark, sf_dir):
    out = schema_report(load(spark, sf_dir, "part"), "part")
    return out.union(schema_report(load(spark, sf_dir, "documents"), "documents"))


def q_header_alias(spark, sf_dir):
    """Old header names take the new ones only where those are absent; absent columns get defaults."""
    customer = require_columns(load(spark, sf_dir, "customer"), ["c_custkey", "c_name"])
    aliased = rename_if_absent(rename_if_absent(customer, "c_name", "Title"), "c_nationkey", "c_custkey")
    full = ensure_columns(aliased, {"BPM": ("double", None), "Mode": ("string", "Major"), "Title": ("string", "never")})
    return full.select("c_custkey", "c_nationkey", "Title", "BPM", "Mode")


def q_missing_columns(spark, sf_dir):
    """What the check of required columns says of each table, beside the rows it would hold back."""
    out = None
    for name in ("part", "customer", "documents"):
        df = load(spark, sf_dir, name)
        try:
            require_columns(df, ["p_partkey", "c_name", "P_NAME"] if name != "documents" else ["doc_id", "text"])
            problem = ""
        except ValueError as e:
            problem = str(e)
        found = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), F.lit(problem).alias("problem"), "n_rows")
        out = found if out is None else out.union(found)
    return out


def q_row_index(spark, sf_dir):
    """Dense row numbers over the documents by (source, doc_id)."""
    docs = load(spark, sf_dir, "documents").select("source", "doc_id")
    return global_row_number(docs, [F.col("source"), F.col("doc_id")], "row_index").select("doc_id", "row_index")


def q_restore_order(spark, sf_dir):
    """Rows shuffled by another key and put back in input order; the position after the sort."""
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("_row"), "p_partkey", "p_brand")
    mixed = part.repartition("p_brand")
    back = restore_order(mixed)
    return global_row_number(back.select("p_partkey"), [F.col("p_partkey")], "position")


def q_nan_frame(spark, sf_dir):
    """Non-finite values of every float column become NULL."""
    ev = load(spark, sf_dir, "events")
    k = F.col("event_id") % 5
    wide = ev.select("event_id", F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).otherwise(F.col("value")).alias("a"),
                     F.when(k == 2, F.lit(float("-inf"))).otherwise(F.col("value")).cast("float").alias("b"), "event_type")
    return round_doubles(io.sanitize_floats(wide).withColumn("b", F.round(F.col("b").cast("double"), 1)))


# --- payload parsers -------------------------------------------------------------------

def _shape():
    return F.col("event_id") % 6


def q_payload_links(spark, sf_dir):
    """Preview addresses and recording ids from three provider shapes."""
    ev = load(spark, sf_dir, "events")
    link = F.concat(F.lit("https://cdn.example.net/"), F.col("event_id").cast("string"))
    shaped = ev.select(
        "event_id",
        F.when(_shape() == 0, F.lit('{"data": []}')).when(_shape() == 1, F.lit("not json"))
         .otherwise(F.to_json(F.struct(F.array(F.struct(link.alias("preview"))).alias("data")))).alias("p1"),
        F.when(_shape() == 2, F.lit('{"recordings": null}')).otherwise(F.to_json(F.struct(F.array(
            F.struct(F.concat(F.lit("rec"), F.col("user_id").cast("string")).alias("id"))).alias("recordings")))).alias("p2"),
        F.when(_shape() == 3, F.lit('{"results": [{}]}')).otherwise(F.to_json(F.struct(F.array(
            F.struct(link.alias("previewUrl"))).alias("results")))).alias("p3"))
    return shaped.select("event_id", payload.deezer_preview("p1").alias("preview"), payload.recording_id("p2").alias("recording"),
                         payload.itunes_preview("p3").alias("preview_url"))


def q_payload_tonal(spark, sf_dir):
    """Mode, tempo and key text from nested analysis documents of several shapes."""
    ev = load(spark, sf_dir, "events")
    v, n = F.round("value", 2).cast("string"), _shape()
    body = (F.when(n == 0, F.concat(F.lit('{"tonal": {"key_scale": {"value": " Major "}, "key_key": {"value": "C"}}, "rhythm": {"bpm": {"value": '), v, F.lit("}}}")))
            .when(n == 1, F.lit('{"tonal": {"key_scale": "minor", "chords_scale": {"value": "major"}}}'))
            .when(n == 2, F.lit('{"tonal": {"key_scale": {"value": "dorian"}, "chords_scale": {"value": 0}, "key_key": {"value": "D"}}, "rhythm": {"bpm": {"value": "fast"}}}'))
            .when(n == 3, F.lit('{"tonal": {"chords_scale": {"value": 1.9}}, "rhythm": {}}')).when(n == 4, F.lit("[]"))
            .otherwise(F.concat(F.lit('{"tonal": {}, "rhythm": {"bpm": {"value": "'), v, F.lit('"}}}'))))
    rows = payload.with_tonal_mode(ev.select("event_id", body.alias("body")), "body", "mode")
    return round_doubles(rows.select("event_id", "mode", payload.rhythm_bpm("body").alias("bpm"), payload.tonal_key_string("body").alias("key_text")))


def q_scale_modes(spark, sf_dir):
    """Mode from scale text and from truncated scale numbers."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    number = (F.col("p_size") - 10).cast("double") / F.lit(4.0)
    label = F.when(F.col("p_type") == "PROMO", F.lit(" MAJOR ")).when(F.col("p_type") == "LARGE", F.lit("minor")).otherwise(F.col("p_type"))
    return part.select("p_partkey", num.mode_from_scale_text(label).alias("from_text"), num.mode_from_scale_number(number).alias("from_number"))


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

_CLIPS = "sum(octet_length(encode(regexp_replace(text, '\\s', ' ', 'g'))) + 1)"

ORACLE = {
    "csv_roundtrip": """SELECT doc_id, 'say "hi", ' || text AS text, CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang,
          row_number() OVER (ORDER BY doc_id) - 1 AS _row FROM documents""",
    "csv_plain_scan": """SELECT p_partkey, p_name, round(p_retailprice, 6) AS p_retailprice,
          row_number() OVER (ORDER BY p_partkey) - 1 AS _row FROM part""",
    "cache_roundtrip": """SELECT p_name || '|||' || p_partkey AS song_key,
          CASE WHEN p_size % 5 > 1 THEN round(p_retailprice, 6) END AS "BPM",
          CASE p_size % 3 WHEN 0 THEN 'a "b"' WHEN 1 THEN 'Minor' END AS "Mode" FROM part""",
    "cache_document": """SELECT p_name || '|||' || p_partkey AS song_key, round(p_retailprice, 6) AS "BPM", 'Major' AS "Mode" FROM part""",
    "lexicon_file": """SELECT word, round(valence, 6) AS valence, arousal FROM (
          SELECT 'word' || (p_partkey % 500) AS word, CAST(p_size AS DOUBLE) / 100 AS valence, CAST(p_partkey AS DOUBLE) AS arousal,
                 row_number() OVER (PARTITION BY p_partkey % 500 ORDER BY p_partkey DESC) AS rn
          FROM part WHERE p_size % 11 > 3) WHERE rn = 1""",
    "reject_list": "SELECT p_name || ' - ' || p_brand AS line, FALSE AS empty_written FROM part WHERE p_size % 4 = 0",
    "listed_lines": """SELECT coalesce(max(n) - min(n) + 1, 0) AS n_lines FROM (
          SELECT row_number() OVER (ORDER BY p_partkey) AS n, p_size, p_partkey, max(p_partkey) OVER () AS top FROM part)
        WHERE p_partkey BETWEEN 3 AND top - 2 AND p_size % 5 <> 0""",
    "schema_report": """WITH n AS (
          SELECT 'part' AS t, column_name AS c, n FROM (SELECT count(COLUMNS(*)) FROM part) UNPIVOT (n FOR column_name IN (COLUMNS(*)))
          UNION ALL SELECT 'documents', column_name, n FROM (SELECT count(COLUMNS(*)) FROM documents) UNPIVOT (n FOR column_name IN (COLUMNS(*))))
        SELECT table_name AS "table", CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column",
          CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS type, n.n AS n_values
        FROM information_schema.columns JOIN n ON n.t = table_name AND n.c = column_name""",
    "header_alias": """SELECT c_custkey, c_nationkey, c_name AS "Title", CAST(NULL AS DOUBLE) AS "BPM", 'Major' AS "Mode" FROM customer""",
    "missing_columns": """SELECT 'part' AS "table", 'missing required columns: [''c_name'', ''P_NAME'']' AS problem, count(*) AS n_rows FROM part
        UNION ALL SELECT 'customer', 'missing required columns: [''p_partkey'', ''P_NAME'']', count(*) FROM customer
        UNION ALL SELECT 'documents', '', count(*) FROM documents""",
    "row_index": "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS row_index FROM documents",
    "restore_order": "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS position FROM part",
    "nan_frame": """SELECT event_id, CASE WHEN event_id % 5 > 1 THEN round(value, 6) END AS a,
          CASE WHEN event_id % 5 <> 2 THEN round(CAST(CAST(value AS FLOAT) AS DOUBLE), 1) END AS b, event_type FROM events""",
    "payload_links": """SELECT event_id,
          CASE WHEN event_id % 6 > 1 THEN 'https://cdn.example.net/' || event_id END AS preview,
          CASE WHEN event_id % 6 <> 2 THEN 'rec' || user_id END AS recording,
          CASE WHEN event_id % 6 <> 3 THEN 'https://cdn.example.net/' || event_id END AS preview_url FROM events""",
    "payload_tonal": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Major' WHEN 1 THEN 'Minor' WHEN 2 THEN 'Minor' WHEN 3 THEN 'Major' END AS mode,
          CASE WHEN event_id % 6 IN (0, 5) THEN round(value, 2) END AS bpm,
          CASE event_id % 6 WHEN 0 THEN 'C  Major ' WHEN 2 THEN 'D dorian' END AS key_text FROM events""",
    "scale_modes": """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Major' WHEN 'LARGE' THEN 'Minor' END AS from_text,
          CASE trunc((p_size - 10) / 4.0) WHEN 1 THEN 'Major' WHEN 0 THEN 'Minor' END AS from_number FROM part""",
    "clip_scan": f"""SELECT clip, n_bytes FROM (SELECT role || (conv_id // {_CLIP_CONVS}) AS clip, CAST({_CLIPS} AS BIGINT) AS n_bytes
          FROM conversations GROUP BY 1) WHERE n_bytes >= {C.MIN_CLIP_BYTES}""",
}

from .gating import _GATE_SQL  # noqa: E402

ORACLE["split_write"] = _GATE_SQL + """
        SELECT CASE WHEN required_ok THEN 'READY' ELSE 'HOLD' END AS ready_to_score, count(*) AS n_rows, count(*) AS n_observed
        FROM g GROUP BY 1"""

QUERIES = {k[2:]: v for k, v in dict(globals()).items() if k.startswith("q_")}
