"""Provider payload extraction (FN-P1..P9): JSON text -> typed columns.

Payloads are parsed once into VARIANT (``try_parse_json``: malformed ->
NULL, never an error) and navigated with ``try_variant_get``.  Python's
``a or b`` over JSON values needs the value's type (0, "", [], {} and
null are falsy), which ``schema_of_variant`` provides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import num
from .text import _col


def parse(payload) -> Column:
    return F.try_parse_json(_col(payload))


def node(v: Column, path: str) -> Column:
    """Sub-value at a JSON path (VARIANT), NULL when absent."""
    return F.try_variant_get(v, path, "variant")


def jtype(n: Column) -> Column:
    return F.schema_of_variant(n)


def as_text(n: Column) -> Column:
    """Scalar as text (numbers in their JSON spelling); NULL for JSON null."""
    return F.when(jtype(n) != "VOID", F.try_variant_get(n, "$", "string"))


def truthy(n: Column) -> Column:
    """Python truthiness of a JSON value (never NULL)."""
    t = jtype(n)
    is_num = t.startswith("DECIMAL") | t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
    return F.coalesce(
        F.when(n.isNull() | (t == "VOID"), F.lit(False))
        .when(t == "STRING", F.try_variant_get(n, "$", "string") != "")
        .when(t == "BOOLEAN", F.try_variant_get(n, "$", "boolean"))
        .when(is_num, F.try_variant_get(n, "$", "double") != 0)
        .when(t.startswith("ARRAY") | t.startswith("OBJECT"),
              ~F.to_json(n).isin("[]", "{}")),
        F.lit(False))


def first_truthy(a: Column, b: Column) -> Column:
    """Python ``a or b``: ``a`` when truthy, else ``b`` (as is)."""
    return F.when(truthy(a), a).otherwise(b)


# --- provider shapes --------------------------------------------------------
# Composite extractors are DataFrame -> DataFrame and add one projection per
# step: every JSON node is computed once and then referenced by name, so the
# truthiness tests do not copy the parse into the expression tree.

def _stage(df: DataFrame, **cols) -> DataFrame:
    return df.withColumns(cols)


def with_deezer_bpm(df: DataFrame, src: str, out: str) -> DataFrame:
    """``data[0].bpm`` when truthy and > 0 (0 means unknown)."""
    t = f"_{out}"
    df = _stage(df, **{t: node(node(parse(src), "$.data"), "$[0].bpm")})
    df = _stage(df, **{out: F.when(truthy(F.col(t)),
                                   num.positive_or_null(num.coerce_number(as_text(F.col(t)))))})
    return df.drop(t)


def deezer_preview(payload) -> Column:
    return as_text(node(node(parse(payload), "$.data"), "$[0].preview"))


def with_search_bpm_mode(df: DataFrame, src: str, bpm_out: str, mode_out: str) -> DataFrame:
    """``(search or result)[0]``: BPM from ``tempo or bpm`` (unparsable ->
    NULL), mode from the key string ``key or song_key`` (kept even when the
    BPM is bad)."""
    t = f"_{bpm_out}"
    df = _stage(df, **{t + "v": parse(src)})
    v = F.col(t + "v")
    df = _stage(df, **{t + "s": node(v, "$.search"), t + "r": node(v, "$.result")})
    df = _stage(df, **{t + "it": node(first_truthy(F.col(t + "s"), F.col(t + "r")), "$[0]")})
    it = F.col(t + "it")
    df = _stage(df, **{t + "tempo": node(it, "$.tempo"), t + "bpm": node(it, "$.bpm"),
                       t + "key": node(it, "$.key"), t + "skey": node(it, "$.song_key")})
    df = _stage(df, **{t + "b": first_truthy(F.col(t + "tempo"), F.col(t + "bpm")),
                       t + "k": first_truthy(F.col(t + "key"), F.col(t + "skey"))})
    df = _stage(df, **{t + "bt": as_text(F.col(t + "b")),
                       t + "kt": F.when(truthy(F.col(t + "k")), as_text(F.col(t + "k")))})
    df = _stage(df, **{bpm_out: num.coerce_number(F.col(t + "bt")),
                       mode_out: num.mode_from_key_string(F.col(t + "kt"))})
    return df.drop(*[c for c in df.columns if c.startswith(t)])


def itunes_preview(payload) -> Column:
    return as_text(node(node(parse(payload), "$.results"), "$[0].previewUrl"))


def recording_id(payload) -> Column:
    return as_text(node(node(parse(payload), "$.recordings"), "$[0].id"))


def _scale_mode(n: Column) -> Column:
    t = jtype(n)
    is_num = t.startswith("DECIMAL") | t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
    return (F.when(t == "STRING", num.mode_from_scale_text(F.try_variant_get(n, "$", "string")))
            .when(t == "BOOLEAN", F.when(F.try_variant_get(n, "$", "boolean"), F.lit("Major"))
                  .otherwise(F.lit("Minor")))
            .when(is_num, num.mode_from_scale_number(F.try_variant_get(n, "$", "double"))))


def with_tonal_mode(df: DataFrame, src: str, out: str) -> DataFrame:
    """Mode from ``tonal.key_scale`` (object with ``value`` or plain
    string), else from ``tonal.chords_scale``."""
    t = f"_{out}"
    df = _stage(df, **{t + "tonal": node(parse(src), "$.tonal")})
    tonal = F.col(t + "tonal")
    df = _stage(df, **{t + "ks": node(tonal, "$.key_scale"), t + "cs": node(tonal, "$.chords_scale")})
    df = _stage(df, **{t + "kst": jtype(F.col(t + "ks")), t + "cst": jtype(F.col(t + "cs"))})

    def value(n, ty):
        return F.when(F.col(ty).startswith("OBJECT"), node(F.col(n), "$.value")).when(F.col(ty) == "STRING", F.col(n))

    df = _stage(df, **{t + "kv": value(t + "ks", t + "kst"), t + "cv": value(t + "cs", t + "cst")})
    df = _stage(df, **{out: F.coalesce(_scale_mode(F.col(t + "kv")), _scale_mode(F.col(t + "cv")))})
    return df.drop(*[c for c in df.columns if c.startswith(t)])


def rhythm_bpm(payload) -> Column:
    return num.coerce_number(as_text(node(parse(payload), "$.rhythm.bpm.value")))


def tonal_key_string(payload) -> Column:
    """``key_key.value + ' ' + key_scale.value`` when both are truthy."""
    v = parse(payload)
    k, s = node(v, "$.tonal.key_key.value"), node(v, "$.tonal.key_scale.value")
    return F.when(truthy(k) & truthy(s), F.concat(as_text(k), F.lit(" "), as_text(s)))


def with_analysis_bpm_mode(df: DataFrame, src: str, bpm_out: str, mode_out: str,
                           by_out: str | None = None) -> DataFrame:
    """Clip-analysis result ``{"bpm": x, "mode": "Major"}``: NaN or bad BPM
    -> NULL (an analyser's 0.0 is kept); mode text as is.  With ``by_out``, the
    analysers named by ``bpm_producer`` and ``mode_producer`` (blank: NULL) go to
    ``<by_out>_bpm`` and ``<by_out>_mode``."""
    t = f"_{bpm_out}"
    df = _stage(df, **{t + "v": parse(src)})
    parts = {t + "b": node(F.col(t + "v"), "$.bpm"), t + "m": node(F.col(t + "v"), "$.mode")}
    if by_out:
        parts |= {f"{t}{k}p": node(F.col(t + "v"), f"$.{k}_producer") for k in ("bpm", "mode")}
    df = _stage(df, **parts)
    texts = {t + "bt": as_text(F.col(t + "b")), t + "mt": as_text(F.col(t + "m"))}
    if by_out:
        texts |= {f"{by_out}_{k}": F.nullif(F.trim(as_text(F.col(f"{t}{k}p"))), F.lit("")) for k in ("bpm", "mode")}
    df = _stage(df, **texts)
    df = _stage(df, **{bpm_out: num.coerce_number(F.col(t + "bt")),
                       mode_out: F.when(F.col(t + "mt") != "", F.col(t + "mt"))})
    return df.drop(*[c for c in df.columns if c.startswith(t)])
