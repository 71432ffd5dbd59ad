"""Listening-context answers: prompt rendering (FN-S13), answer parsing
(FN-P7), cached-answer lookup (JOI-12), idempotent work set (PRJ-14) and
batch inference over only the unanswered keys (INF-2, JOI-13, AGG-12).

One row per unanswered key (its first row in input order) is asked, with the
whole rendered prompt.  The default model is a native rule; a user's model is a
``mapInPandas`` function.  Only answers that parse become cache entries; the
others come back as a frame of failures and stay pending.

A model's answers are saved while its task runs: every few keys go to a log in the shared folder, one
folder a bucket of keys, and a task reads its buckets' logs before it asks.  So what a lost
executor, or a run that failed, was answered isn't asked again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import num, text
from ..session import shared_path, ship_package
from .common import lookup_join, materialised
from .merge import first_per_key

ANSWER_FIELDS = ("listening_context", "contraindications", "rationale")
OUTPUTS = ("listening_context", "contraindications")
PROMPT_INPUTS = ("bpm", "mode", "valence", "lyric_valence", "lyric_arousal")
SAFE_RAW_SCHEMA = "answer_key string, raw string, error string"
SAVE_EVERY = 100        # keys between two saves of a task


def parse_answer(raw) -> list:
    """JSON answer text -> the three fields plus ``parse_ok`` (malformed or
    non-object JSON -> NULL fields, parse_ok false; never raises)."""
    v = F.try_parse_json(text._col(raw))
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    fields = [F.when(is_obj, F.try_variant_get(v, f"$.{f}", "string")).alias(f) for f in ANSWER_FIELDS]
    return fields + [is_obj.alias("parse_ok")]


def work_set(tracks: DataFrame, title: str = "title", artist: str = "artist") -> DataFrame:
    """Rows that need an answer: title and artist non-blank, and not both
    outputs already filled (one filled output is redone)."""
    filled = F.lit(True)
    for c in OUTPUTS:
        old = F.col(c).cast("string") if c in tracks.columns else F.lit(None).cast("string")
        filled = filled & (F.coalesce(old, F.lit("")) != "")
    t = F.coalesce(text.strip(title), F.lit(""))
    a = F.coalesce(text.strip(artist), F.lit(""))
    return tracks.where(~filled & (t != "") & (a != ""))


def rule_based_answer(lval: Column, laro: Column) -> Column:
    """The default model, as JSON text: arousal is to go down when lyric valence
    is negative or lyric arousal is above 0.7."""
    down = F.coalesce(lval < 0, F.lit(False)) | F.coalesce(laro > 0.7, F.lit(False))
    return F.to_json(F.struct(
        F.when(down, "seated, eyes closed, paced breathing, 10 min")
         .otherwise("solo listening with breathing guidance, 10 min").alias("listening_context"),
        F.when(down, "stop if agitation rises; avoid during acute distress")
         .otherwise("none noted").alias("contraindications"),
        F.concat(F.lit("lval="), text.fmt2_or_na(lval), F.lit(" laro="), text.fmt2_or_na(laro)).alias("rationale")))


def isolate_rows(model: Callable) -> Callable:
    """Row-level failure isolation for a model hook: a batch that raises is
    retried row by row; a row that still raises yields raw NULL and its whole
    error text, and the task goes on."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            try:
                out = pd.concat(list(model(iter([pdf]))), ignore_index=True)
                yield out.assign(error=None)[["answer_key", "raw", "error"]]
                continue
            except Exception:  # noqa: BLE001 - isolate and retry per row
                pass
            rows = []
            for i in range(len(pdf)):
                one = pdf.iloc[i:i + 1]
                try:
                    got = pd.concat(list(model(iter([one]))), ignore_index=True)
                    rows.append(got.assign(error=None)[["answer_key", "raw", "error"]])
                except Exception as e:  # noqa: BLE001
                    rows.append(pd.DataFrame({"answer_key": one["answer_key"].to_numpy(),
                                              "raw": [None], "error": [f"{type(e).__name__}: {e}"]}))
            yield pd.concat(rows, ignore_index=True)
    return run


def log_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` as tasks reach it, and the path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


def saved_answers(system: fs.FileSystem, folder: str, run: str) -> dict:
    """{key: (raw, error)} of one bucket's log.  Of other runs only JSON objects count; the rest is asked again."""
    def answers(raw):
        try:
            return isinstance(json.loads(raw or ""), dict)
        except ValueError:
            return False

    saved = {}
    for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if f.base_name.endswith(".parquet"):
            same = f.base_name.startswith(run)
            with system.open_input_file(f.path) as src:
                for r in pq.read_table(src).to_pylist():
                    if same or answers(r["raw"]):
                        saved[r["answer_key"]] = r["raw"], r["error"]
    return saved


def logged(model: Callable, log: str, run: str, save_every: int) -> Callable:
    """``model`` (after ``isolate_rows``) behind the log of answers: rows come with their ``bucket``, a bucket's rows one after
    the other.  Files are written aside and renamed, so a reader sees whole ones."""
    answered = ["answer_key", "raw", "error"]

    def run_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = log_folder(log)
        bucket, saved = None, {}
        for pdf in batches:
            for b, rows in pdf.groupby("bucket", sort=False):
                folder = f"{base}/bucket={b}"
                if b != bucket:
                    bucket, saved = b, saved_answers(system, folder, run)
                known = rows["answer_key"].isin(list(saved))
                if known.any():
                    keys = rows["answer_key"][known]
                    yield pd.DataFrame([(k, *saved[k]) for k in keys], columns=answered)
                todo = rows[~known].drop(columns="bucket")
                for at in range(0, len(todo), save_every):
                    got = pd.concat(list(model(iter([todo.iloc[at:at + save_every].reset_index(drop=True)]))), ignore_index=True)[answered]
                    table = pa.Table.from_pandas(got, pa.schema([(c, pa.string()) for c in answered]), preserve_index=False)
                    system.create_dir(folder, recursive=True)
                    name = f"{folder}/{run}-{uuid.uuid4().hex}"
                    with system.open_output_stream(name + ".tmp") as out:
                        pq.write_table(table, out)
                    system.move(name + ".tmp", name + ".parquet")
                    yield got
    return run_task


def ask(firsts: DataFrame, model: Callable, log: str | None, save_every: int, buckets: int | None) -> DataFrame:
    """(answer_key, raw, error) of each row of ``firsts`` by ``model``, written once."""
    spark = firsts.sparkSession
    ship_package(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = log or shared_path(spark, "answer-log")
    dealt = (firsts.withColumn("bucket", F.pmod(F.xxhash64("answer_key"), F.lit(n)).cast("int"))
             .repartition(n, "bucket").sortWithinPartitions("bucket"))
    # written once: the answers are read three times, and that may bring no second round of calls either
    return materialised(dealt.mapInPandas(logged(isolate_rows(model), folder, uuid.uuid4().hex, save_every), SAFE_RAW_SCHEMA), "answers")


def with_prompt(tracks: DataFrame, title: str = "title", artist: str = "artist", **inputs: str) -> DataFrame:
    """``tracks`` with ``prompt``: the full text for each row (attributes, task,
    constraints).  ``inputs`` renames the columns of ``PROMPT_INPUTS``; absent ones
    read as missing."""
    cols = {}
    for name in PROMPT_INPUTS:
        src = inputs.get(name, name)
        kind = "string" if name == "mode" else "double"
        col = F.col(src) if src in tracks.columns else F.lit(None)
        cols[name] = col.cast(kind) if name == "mode" else num.sanitize(col)
    names = [F.coalesce(F.col(c) if c in tracks.columns else F.lit(None).cast("string"), F.lit("")) for c in (title, artist)]
    return tracks.withColumn("prompt", text.prompt_text(*names, *[cols[n] for n in PROMPT_INPUTS]))


def infer_answers(tracks: DataFrame, answers: DataFrame, order_col: str, model: Callable | None = None,
                  title: str = "title", artist: str = "artist", lval: str = "lyric_valence",
                  laro: str = "lyric_arousal", prompt: str | None = None, log: str | None = None,
                  save_every: int = SAVE_EVERY, buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(filled tracks, new answer snapshot, failures).

    ``tracks`` carry ``answer_key``, ``order_col`` and the prompt's inputs (or a
    column ``prompt`` that holds the text); ``answers`` is the cached snapshot
    (answer_key + the three fields, one row per key).  Only keys absent from it
    are asked, once each.  ``model``: a ``mapInPandas`` function that gets
    answer_key, prompt, system, title, artist, lval, laro and returns answer_key,
    raw; None is the native rule.  It gets at most ``save_every`` keys at a time, whose answers are
    then saved in ``log``: a shared folder (by default a new one), which a later run may name again to
    take over what a failed run was answered.  Keys are dealt into ``buckets`` by their hash (by default as many
    as shuffle partitions; the same number for the same log); a task holds the saved answers of one bucket.

    Filled tracks have the columns of ``tracks`` with the three fields replaced
    and ``answer_source`` (cache, model, or NULL without an answer).  Failures
    (answer_key, raw, error, parse_ok) are no cache entries, so a later run asks
    again."""
    old = [c for c in (*ANSWER_FIELDS, "answer_source") if c in tracks.columns]
    t = tracks.drop(*old)
    asked = t if prompt is not None else with_prompt(t, title, artist, lyric_valence=lval, lyric_arousal=laro)
    value = lambda c: F.col(c).cast("double") if c in t.columns else F.lit(None).cast("double")
    name = lambda c: text.strip(c) if c in t.columns else F.lit(None).cast("string")
    asked = asked.select("answer_key", order_col, F.col(prompt or "prompt").alias("prompt"), F.lit(C.PROMPT_SYSTEM).alias("system"),
                         name(title).alias("title"), name(artist).alias("artist"),
                         value(lval).alias("lval"), value(laro).alias("laro")).where("answer_key is not null")
    pending = lookup_join(asked, answers.select("answer_key"), ["answer_key"], "left_anti")
    firsts = first_per_key(pending, ["answer_key"], order_col).drop(order_col)
    if model is None:
        raw = firsts.select("answer_key", rule_based_answer(F.col("lval"), F.col("laro")).alias("raw"),
                            F.lit(None).cast("string").alias("error"))
    else:
        raw = ask(firsts, model, log, save_every, buckets)
    parsed = raw.select("answer_key", "raw", "error", *parse_answer("raw"))
    snapshot = (answers.select("answer_key", *ANSWER_FIELDS).withColumn("answer_source", F.lit("cache"))
                .unionByName(parsed.where("parse_ok").select("answer_key", *ANSWER_FIELDS)
                             .withColumn("answer_source", F.lit("model"))))
    filled = lookup_join(t, snapshot, ["answer_key"])
    return filled, snapshot, parsed.where("not parse_ok").select("answer_key", "raw", "error", "parse_ok")


def fill_context(tracks: DataFrame, filled: DataFrame, order_col: str) -> DataFrame:
    """``tracks`` with both outputs overwritten in the rows that ``filled`` has an
    answer for (NULLs of the answer too); all other rows keep what they had."""
    upd = (filled.where("answer_source is not null")
           .select(F.col(order_col).alias("_r"), *[F.col(c).alias(f"_{c}") for c in OUTPUTS], F.lit(True).alias("_hit")))
    out = tracks.join(upd, tracks[order_col] == upd["_r"], "left")
    for c in OUTPUTS:
        old = F.col(c) if c in tracks.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(old))
    return out.drop("_r", "_hit", *[f"_{c}" for c in OUTPUTS])


def lookup_answers(tracks: DataFrame, answers: DataFrame) -> DataFrame:
    """Tracks with their cached answer (case-sensitive key); rows without
    one are flagged ``needs_inference``."""
    a = answers.select("answer_key", *ANSWER_FIELDS, "parse_ok").withColumn("_hit", F.lit(True))
    j = lookup_join(tracks, a, ["answer_key"])
    return j.withColumn("needs_inference", F.col("_hit").isNull()).drop("_hit")


def count_updates(filled: DataFrame) -> DataFrame:
    """Rows written in this run: those with an answer, cached or new, whatever it says."""
    return filled.agg(F.count_if(F.col("answer_source").isNotNull()).alias("updated_rows"),
                      F.count(F.lit(1)).alias("n_rows"))
