"""Context-fill plans: part plays the tracks (title = p_name, artist =
p_brand), conversations supply stored answers (assistant turns as JSON, one
branch malformed)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text
from ..operators.answers import count_updates, fill_context, infer_answers, lookup_answers, parse_answer, work_set
from .base import load, round_doubles
from .scoring import AFFECT_SQL, affect_columns


def _tracks(spark, sf_dir):
    return load(spark, sf_dir, "part").withColumns(affect_columns())


def q_prompt_render(spark, sf_dir):
    t = _tracks(spark, sf_dir)
    size = F.col("p_size")
    sval = F.when(size % 3 != 0, (size % 21 - 5).cast("double") / F.lit(20.0))
    bpm = F.when(F.col("p_type") != "SMALL", F.col("bpm"))
    laro = (size % 11).cast("double") / F.lit(10.0)
    return t.select("p_partkey", text.answer_key("p_name", "p_brand").alias("answer_key"),
                    text.prompt_text("p_name", "p_brand", bpm, "mode", sval,
                                     F.col("lyric_valence"), laro).alias("prompt"))


def _answers(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    body = F.to_json(F.struct(F.col("text").alias("listening_context"),
                              F.lower("text").alias("contraindications"),
                              F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("rationale")))
    raw = F.when(F.col("turn") % 4 == 3, F.concat(F.lit('{"listening_context": '), F.col("conv_id").cast("string")))\
           .otherwise(body)
    keyed = conv.select(F.concat(F.lit("conv "), F.col("conv_id").cast("string"), F.lit("|||user")).alias("answer_key"),
                        "turn", raw.alias("raw"))
    last = keyed.groupBy("answer_key").agg(F.max_by("raw", "turn").alias("raw"))
    return last.select("answer_key", *parse_answer("raw"))


def q_answer_parse(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations").select("conv_id").distinct()
    tracks = conv.select("conv_id", F.concat(F.lit("conv "), F.col("conv_id").cast("string"), F.lit("|||"),
                                             F.when(F.col("conv_id") % 5 == 0, F.lit("USER"))
                                              .otherwise(F.lit("user"))).alias("answer_key"))
    return lookup_answers(tracks, _answers(spark, sf_dir))


def q_batch_inference(spark, sf_dir):
    t = _tracks(spark, sf_dir).withColumn("answer_key", text.answer_key("p_name", "p_brand"))
    cached = (t.where(F.col("p_type") == "PROMO").select("answer_key").distinct()
              .select("answer_key", F.lit("cached context").alias("listening_context"),
                      F.lit("cached contraindications").alias("contraindications"),
                      F.lit("from snapshot").alias("rationale")))
    filled, _, _ = infer_answers(t, cached, "p_partkey", title="p_name", artist="p_brand")
    return round_doubles(filled.select("p_partkey", "answer_key", "listening_context",
                                       "contraindications", "rationale", "answer_source"))


def picky_model(batches):
    """A model hook for the plans: by the length of the answer key it fails, answers
    with broken JSON, gives no answer, or reads title and prompt."""
    for pdf in batches:
        raw = []
        for key, title, prompt in zip(pdf["answer_key"], pdf["title"], pdf["prompt"]):
            k = len(key) % 7
            if k == 0:
                raise RuntimeError(f"no answer for {key}")
            n = str(prompt.count("\n"))
            raw.append('{"listening_context": ' if k == 1 else None if k == 2 else json.dumps(
                {"listening_context": f"plan for {title}", "contraindications": None if k == 3 else f"lines {n}", "rationale": "r"}))
        yield pd.DataFrame({"answer_key": pdf["answer_key"], "raw": raw})


def _context(spark, sf_dir):
    """Tracks of which some have both outputs, some one, some none; a cache whose entries
    have one NULL field; ``picky_model`` for the rest."""
    size = F.col("p_size")
    t = _tracks(spark, sf_dir).withColumnsRenamed({"p_name": "title"}).withColumns({
        "artist": F.when(size != 13, F.col("p_brand")),
        "listening_context": F.when(size % 4 <= 1, F.lit("kept context")),
        "contraindications": F.when(size % 4 == 0, F.lit("kept contraindications"))})
    todo = work_set(t).withColumn("answer_key", text.answer_key("title", "artist"))
    cached = (todo.where(F.col("p_type") == "PROMO").select("answer_key").distinct()
              .select("answer_key", F.lit("cached context").alias("listening_context"),
                      F.lit(None).cast("string").alias("contraindications"), F.lit("from snapshot").alias("rationale")))
    filled, snapshot, failures = infer_answers(todo, cached, "p_partkey", model=picky_model)
    return t, filled, snapshot, failures


def q_context_fill(spark, sf_dir):
    t, filled, _, _ = _context(spark, sf_dir)
    return fill_context(t, filled, "p_partkey").select("p_partkey", "listening_context", "contraindications")


def q_context_failures(spark, sf_dir):
    failures = _context(spark, sf_dir)[3]
    return failures.select("answer_key", "raw", "error", "parse_ok")


def q_context_cache(spark, sf_dir):
    return _context(spark, sf_dir)[2].select("answer_key", "listening_context", "contraindications", "rationale", "answer_source")


def q_answer_updates(spark, sf_dir):
    return count_updates(_context(spark, sf_dir)[1])


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

def _f2(x: str) -> str:
    return f"coalesce(printf('%.2f', {x}), 'NA')"


_TAIL = "'" + C.PROMPT_TEMPLATE[C.PROMPT_TEMPLATE.index("\n\nTask:"):].replace("'", "''") + "'"
_PROMPT_LINES = C.PROMPT_TEMPLATE.count("\n")
_CONTEXT_SQL = f"""WITH t AS (
      SELECT p_partkey, p_type, trim(p_name) AS title, coalesce(trim(p_name), '') || '|||' ||
             coalesce(trim(CASE WHEN p_size <> 13 THEN p_brand END), '') AS answer_key,
             CASE WHEN p_size % 4 <= 1 THEN 'kept context' END AS old_ctx,
             CASE WHEN p_size % 4 = 0 THEN 'kept contraindications' END AS old_con,
             p_size % 4 <> 0 AND p_size <> 13 AS todo
      FROM part
    ), cached AS (SELECT DISTINCT answer_key FROM t WHERE todo AND p_type = 'PROMO'),
    asked AS (SELECT answer_key, any_value(title) AS title, length(answer_key) % 7 AS k FROM t
              WHERE todo AND answer_key NOT IN (SELECT answer_key FROM cached) GROUP BY answer_key),
    snap AS (
      SELECT answer_key, 'cached context' AS listening_context, NULL AS contraindications,
             'from snapshot' AS rationale, 'cache' AS answer_source FROM cached
      UNION ALL
      SELECT answer_key, 'plan for ' || title, CASE WHEN k <> 3 THEN 'lines {_PROMPT_LINES}' END, 'r', 'model'
      FROM asked WHERE k > 2)"""

ORACLE = {
    "context_fill": _CONTEXT_SQL + """
        SELECT p_partkey,
          CASE WHEN todo AND s.answer_key IS NOT NULL THEN s.listening_context ELSE old_ctx END AS listening_context,
          CASE WHEN todo AND s.answer_key IS NOT NULL THEN s.contraindications ELSE old_con END AS contraindications
        FROM t LEFT JOIN snap s ON s.answer_key = t.answer_key""",
    "context_failures": _CONTEXT_SQL + """
        SELECT answer_key, CASE WHEN k = 1 THEN '{"listening_context": ' END AS raw,
          CASE WHEN k = 0 THEN 'RuntimeError: no answer for ' || answer_key END AS error, FALSE AS parse_ok
        FROM asked WHERE k <= 2""",
    "context_cache": _CONTEXT_SQL + " SELECT * FROM snap",
    "answer_updates": _CONTEXT_SQL + """
        SELECT count(s.answer_key) AS updated_rows, count(*) AS n_rows
        FROM (SELECT * FROM t WHERE todo) t LEFT JOIN snap s ON s.answer_key = t.answer_key""",
    "prompt_render": f"""WITH a AS ({AFFECT_SQL}), t AS (
          SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, a.bpm, a.mode, a.lyric_valence
          FROM part p JOIN a ON a.p_partkey = p.p_partkey)
        SELECT p_partkey, trim(p_name) || '|||' || trim(p_brand) AS answer_key,
          'Song: ' || trim(p_name) || ' — ' || trim(p_brand) || chr(10) || 'Attributes:' || chr(10)
          || '- BPM: ' || coalesce(CASE WHEN p_type <> 'SMALL' THEN CAST(bpm AS VARCHAR) END, 'NA') || chr(10)
          || '- Mode: ' || CASE WHEN trim(mode) <> '' THEN trim(mode) ELSE 'NA' END || chr(10)
          || '- Spotify valence: ' || {_f2("CASE WHEN p_size % 3 <> 0 THEN CAST(p_size % 21 - 5 AS DOUBLE) / 20.0 END")} || chr(10)
          || '- Lyric valence: ' || {_f2('lyric_valence')} || chr(10)
          || '- Lyric arousal: ' || {_f2('CAST(p_size % 11 AS DOUBLE) / 10.0')} || {_TAIL} AS prompt
        FROM t""",
    "answer_parse": """WITH last AS (
          SELECT answer_key, turn, text, conv_id FROM (
            SELECT 'conv ' || conv_id || '|||user' AS answer_key, turn, text, conv_id,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
            FROM conversations WHERE role = 'assistant') WHERE rn = 1
        ), ans AS (
          SELECT answer_key,
                 CASE WHEN turn % 4 <> 3 THEN text END AS listening_context,
                 CASE WHEN turn % 4 <> 3 THEN lower(text) END AS contraindications,
                 CASE WHEN turn % 4 <> 3 THEN 'turn ' || turn END AS rationale,
                 turn % 4 <> 3 AS parse_ok
          FROM last
        ), tracks AS (
          SELECT conv_id, 'conv ' || conv_id || '|||' || CASE WHEN conv_id % 5 = 0 THEN 'USER' ELSE 'user' END AS answer_key
          FROM (SELECT DISTINCT conv_id FROM conversations)
        )
        SELECT t.conv_id, t.answer_key, a.listening_context, a.contraindications, a.rationale, a.parse_ok,
               a.answer_key IS NULL AS needs_inference
        FROM tracks t LEFT JOIN ans a ON a.answer_key = t.answer_key""",
    "batch_inference": f"""WITH a AS ({AFFECT_SQL}), t AS (
          SELECT p.p_partkey, p.p_type, trim(p.p_name) || '|||' || trim(p.p_brand) AS answer_key,
                 a.lyric_valence AS lval, a.lyric_arousal AS laro
          FROM part p JOIN a ON a.p_partkey = p.p_partkey
        ), cached AS (SELECT DISTINCT answer_key FROM t WHERE p_type = 'PROMO'),
        firsts AS (
          SELECT answer_key, lval, laro FROM (
            SELECT answer_key, lval, laro, row_number() OVER (PARTITION BY answer_key ORDER BY p_partkey) AS rn
            FROM t WHERE answer_key NOT IN (SELECT answer_key FROM cached)) WHERE rn = 1
        ), model AS (
          SELECT answer_key,
            CASE WHEN lval < 0 OR laro > 0.7 THEN 'seated, eyes closed, paced breathing, 10 min'
                 ELSE 'solo listening with breathing guidance, 10 min' END AS listening_context,
            CASE WHEN lval < 0 OR laro > 0.7 THEN 'stop if agitation rises; avoid during acute distress'
                 ELSE 'none noted' END AS contraindications,
            'lval=' || coalesce(printf('%.2f', lval), 'NA') || ' laro=' || coalesce(printf('%.2f', laro), 'NA') AS rationale,
            'model' AS answer_source
          FROM firsts
        ), snap AS (
          SELECT answer_key, 'cached context' AS listening_context, 'cached contraindications' AS contraindications,
                 'from snapshot' AS rationale, 'cache' AS answer_source FROM cached
          UNION ALL SELECT * FROM model
        )
        SELECT t.p_partkey, t.answer_key, s.listening_context, s.contraindications, s.rationale, s.answer_source
        FROM t LEFT JOIN snap s ON s.answer_key = t.answer_key""",
}

QUERIES = {
    "context_fill": q_context_fill,
    "context_failures": q_context_failures,
    "context_cache": q_context_cache,
    "answer_updates": q_answer_updates,
    "prompt_render": q_prompt_render,
    "answer_parse": q_answer_parse,
    "batch_inference": q_batch_inference,
}
