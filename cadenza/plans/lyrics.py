"""Lyrics plans over the driver tables: documents play the lyrics, benchmark
supplies the lexicon words, labels the fallback scorers, conversations
multi-line fetched text, part the song titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import num, text
from ..operators.quality import classify_lyrics, flagged_rows, status_counts
from ..operators.sentiment import lexicon_scores, lyric_sentiment, lyrics_lookup, polarity_scores
from .base import dbl, load, round_doubles

# Adapter values chosen from words that occur in the driver documents.
STATUS_CFG = C.LyricStatusConfig(short_words=C.SHORT_WORDS,
                                 instrumental_words=("avec", "und"),
                                 summary_keywords=("that the", "it is"))
FETCH_WORDS = ("avec", "with the")
GATE_MARKERS = {"contributors": "this", "read_more": "Version", "page": "THE!!"}
CACHED_SOURCES = ("src0", "src1", "src2")


def benchmark_lexicon(spark, sf_dir):
    """Lexicon = distinct benchmark tokens with values from a fixed rule."""
    words = (load(spark, sf_dir, "benchmark")
             .select(F.explode(text.tokens("text")).alias("word")).distinct())
    a, n = F.ascii("word"), F.length("word")
    return words.select(
        "word",
        ((a * 7 + n * 13) % 101).cast("double").alias("valence") / F.lit(100.0),
        ((a * 11 + n * 17) % 101).cast("double").alias("arousal") / F.lit(100.0),
    ).toDF("word", "valence", "arousal")


def q_lexicon_sentiment(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = lexicon_scores(docs, "doc_id", "text", benchmark_lexicon(spark, sf_dir))
    return round_doubles(out.select("doc_id", F.col("lex_valence").alias("lyric_valence"),
                                    F.col("lex_arousal").alias("lyric_arousal"), "lex_hits"))


def q_lexicon_own_words(spark, sf_dir):
    """Scores by a lexicon of the documents' own words (those of some lengths), joined by shuffle."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    words = docs.select(F.explode(text.tokens("text")).alias("word")).distinct().where(F.length("word") % 3 != 0)
    lex = words.select("word", (F.ascii("word") % 10).cast("double").alias("valence"), (F.length("word") % 7).cast("double").alias("arousal"))
    out = lexicon_scores(docs, "doc_id", "text", lex, shuffled=True)
    return round_doubles(out.select("doc_id", F.col("lex_valence").alias("lyric_valence"),
                                    F.col("lex_arousal").alias("lyric_arousal"), "lex_hits"))


def _rescaled(col, mapping: dict):
    expr = None
    for k, v in mapping.items():
        val = num.rescale_polarity(F.lit(float(v)))
        expr = F.when(col == k, val) if expr is None else expr.when(col == k, val)
    return expr


def q_polarity_scorers(spark, sf_dir):
    """Both fallback scorers from polarity lexicons: benchmark words of even and of odd length."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    words = load(spark, sf_dir, "benchmark").select(F.explode(text.tokens("text")).alias("word")).distinct()
    a, n = F.ascii("word"), F.length("word")
    lex = words.select("word", n.alias("n"), (((a * 5 + n * 3) % 201 - 100).cast("double") / F.lit(100.0)).alias("polarity"))
    p1 = polarity_scores(docs, "doc_id", "text", lex.where("n % 2 = 0"), "p1")
    p2 = polarity_scores(docs, "doc_id", "text", lex.where("n % 2 = 1"), "p2")
    return round_doubles(p1.join(p2, "doc_id"))


P1_POLARITY = {1: 0.6, 0: -1.0}   # by labels.quality
P2_POLARITY = {1: -0.5, 0: 0.4}   # by labels.toxic


def q_sentiment_fallback(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels")
    scores = labels.select("doc_id", _rescaled(F.col("quality"), P1_POLARITY).alias("p1"),
                           _rescaled(F.col("toxic"), P2_POLARITY).alias("p2"))
    cache = docs.where(F.col("source").isin(*CACHED_SOURCES)).select(
        "doc_id",
        F.when(F.col("lang") == "es", F.lit("n/a"))
         .otherwise(((F.col("n_chars") % 100).cast("double") / F.lit(100.0)).cast("string"))
         .alias("cached_valence"),
        F.when(F.col("lang") != "de", (F.col("n_chars") % 89).cast("double") / F.lit(100.0))
         .alias("cached_arousal"))
    out = lyric_sentiment(docs.select("doc_id", "text"), "doc_id", "text",
                          benchmark_lexicon(spark, sf_dir), scores=scores, cache=cache)
    return round_doubles(out)


def _classified(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("lyrics"))
    return classify_lyrics(docs, "lyrics", STATUS_CFG)


def q_lyric_status(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "word_count", "lyrics_status")


def q_lyric_status_counts(spark, sf_dir):
    return status_counts(_classified(spark, sf_dir))


def q_lyric_report(spark, sf_dir):
    return flagged_rows(_classified(spark, sf_dir)).select("doc_id", "lyrics_status", "word_count")


def q_clean_lyrics_fetch(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", text.clean_lyrics_fetch("text", FETCH_WORDS).alias("lyrics"))


def q_clean_lyrics_gate(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_lyrics_gate("text", **GATE_MARKERS).alias("lyrics"))


def q_mojibake_repair(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    bad = text.corrupt_latin1(F.col("text"))
    fixed = text.fix_mojibake(bad)
    return docs.select("doc_id", text.has_mojibake(bad).alias("mojibake"),
                       fixed.alias("repaired"), (fixed == F.col("text")).alias("restored"))


CACHED_LYRIC_SOURCES = ("src3", "src4", "src5")


def q_lyrics_lookup(spark, sf_dir):
    """Tracks = part rows; fetched lyrics = the document with doc_id =
    p_partkey; cached lyrics = some documents' text, blank for one language."""
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_id"))
    docs = load(spark, sf_dir, "documents")
    source = docs.select(F.col("doc_id").alias("track_id"), F.col("text").alias("lyrics"))
    cache = docs.where(F.col("source").isin(*CACHED_LYRIC_SOURCES)).select(
        F.col("doc_id").alias("track_id"),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(F.upper("text")).alias("lyrics"))
    return lyrics_lookup(part, "track_id", cache, source, FETCH_WORDS)


def song_titles(spark, sf_dir):
    """Titles/artists from part, decorated with version suffixes, brackets,
    case and spacing so every key rule has work to do."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    name, size = F.col("p_name"), F.col("p_size")
    title = (F.when(size % 7 == 0, F.concat(name, F.lit("-Lived Day")))
             .when(size % 4 == 0, name)
             .when(size % 4 == 1, F.concat(name, F.lit(" (x)")))
             .when(size % 4 == 2, F.concat(F.lit("  "), F.upper(name), F.lit(" - Live")))
             .otherwise(F.concat(name, F.lit("  -  Remastered 2011"))))
    artist = (F.when(size % 3 == 0, F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")))
              .otherwise(F.upper(F.col("p_brand"))))
    return part.select("p_partkey", title.alias("title"), artist.alias("artist"))


def q_song_keys(spark, sf_dir):
    s = song_titles(spark, sf_dir)
    return s.select("p_partkey", "title", "artist",
                    text.enrich_key("title", "artist").alias("enrich_key"),
                    text.lyrics_key("title", "artist").alias("lyrics_key"),
                    text.answer_key("title", "artist").alias("answer_key"),
                    text.merge_norm("title").alias("title_norm"),
                    text.merge_norm("artist").alias("artist_norm"),
                    text.search_text(text.strip("title"), text.strip("artist")).alias("search_text"),
                    text.search_words(text.strip("title"), text.strip("artist")).alias("search_words"))


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB, RE2: word boundaries spelled out, ASCII \s is enough on
# this data, which has no non-ASCII whitespace)
# ---------------------------------------------------------------------------

NB = r"[^\pL\p{Nd}_]"
TOK = "regexp_extract_all(lower(text), '[A-Za-z'']+')"
LEX_SQL = f"""lex AS (
  SELECT word, CAST((ascii(word) * 7 + length(word) * 13) % 101 AS DOUBLE) / {dbl(100.0)} AS valence,
         CAST((ascii(word) * 11 + length(word) * 17) % 101 AS DOUBLE) / {dbl(100.0)} AS arousal
  FROM (SELECT DISTINCT unnest({TOK}) AS word FROM benchmark)
), toks AS (
  SELECT doc_id, unnest({TOK}) AS word FROM documents
), lexagg AS (
  SELECT d.doc_id, avg(h.valence) AS v, avg(h.arousal) AS a, count(h.valence) AS hits
  FROM documents d LEFT JOIN (SELECT toks.doc_id, lex.valence, lex.arousal FROM toks JOIN lex USING (word)) h
    ON h.doc_id = d.doc_id
  GROUP BY d.doc_id
)"""

PYSTRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _strip(x: str) -> str:
    return PYSTRIP.format(x=x)


def _wc(x: str) -> str:
    s = _strip(x)
    return f"CASE WHEN {s} = '' THEN 0 ELSE len(regexp_split_to_array({s}, '\\s+')) END"


def _status_sql(x: str) -> str:
    low = f"lower({_strip(x)})"
    instr = "|".join(STATUS_CFG.instrumental_words)
    summ = " OR ".join(f"contains({low}, '{k}')" for k in STATUS_CFG.summary_keywords)
    return (f"CASE WHEN {x} IS NULL OR {_wc(x)} = 0 THEN 'MISSING' "
            f"WHEN regexp_matches({low}, '(^|{NB})({instr})({NB}|$)') THEN 'INSTRUMENTAL' "
            f"WHEN {_wc(x)} < {STATUS_CFG.short_words} THEN 'SHORT' "
            f"WHEN {summ} THEN 'SUMMARY' ELSE 'GOOD' END")


_NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _resc_sql(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN ({dbl(float(v))} + {dbl(1.0)}) / {dbl(2.0)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _corrupt_sql(x: str) -> str:
    """UTF-8 bytes of each character, each byte read back as a Latin-1 char."""
    cp = "unicode(ch)"
    return f"""list_aggr(list_transform(string_split({x}, ''), lambda ch:
        CASE WHEN {cp} < 128 THEN ch
             WHEN {cp} < 2048 THEN chr(192 + ({cp} >> 6)) || chr(128 + ({cp} & 63))
             WHEN {cp} < 65536 THEN chr(224 + ({cp} >> 12)) || chr(128 + (({cp} >> 6) & 63)) || chr(128 + ({cp} & 63))
             ELSE chr(240 + ({cp} >> 18)) || chr(128 + (({cp} >> 12) & 63)) || chr(128 + (({cp} >> 6) & 63)) || chr(128 + ({cp} & 63))
        END), 'string_agg', '')"""


def _telltale_sql(x: str) -> str:
    lits = [" || ".join(f"chr({ord(ch)})" for ch in t) for t in C.MOJIBAKE_TELLTALES]
    return "(" + " OR ".join(f"contains({x}, {lit})" for lit in lits) + ")"


def _title_sql() -> str:
    return """CASE WHEN p_size % 7 = 0 THEN p_name || '-Lived Day'
                   WHEN p_size % 4 = 0 THEN p_name
                   WHEN p_size % 4 = 1 THEN p_name || ' (x)'
                   WHEN p_size % 4 = 2 THEN '  ' || upper(p_name) || ' - Live'
                   ELSE p_name || '  -  Remastered 2011' END"""


_FETCH_CLEAN = ("coalesce(" + _strip(
    "regexp_replace(regexp_replace(regexp_replace(d.text, '(?mi)^.*(" + '|'.join(FETCH_WORDS)
    + ").*$', '', 'g'), '\\[.*?\\]', ' ', 'g'), '\\s+', ' ', 'g')") + ", '')")

ORACLE = {
    "lyrics_lookup": f"""WITH c AS (
          SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE upper(text) END AS cached
          FROM documents WHERE source IN {CACHED_LYRIC_SOURCES})
        SELECT p.p_partkey AS track_id,
          CASE WHEN c.cached <> '' THEN c.cached WHEN d.text <> '' THEN {_FETCH_CLEAN} ELSE '' END AS lyrics,
          CASE WHEN c.cached <> '' THEN 'cache' WHEN d.text <> '' THEN 'fetched' ELSE 'none' END AS lyrics_origin
        FROM part p LEFT JOIN c ON c.doc_id = p.p_partkey LEFT JOIN documents d ON d.doc_id = p.p_partkey""",
    "polarity_scorers": f"""WITH w AS (
          SELECT word, length(word) % 2 AS odd, CAST((ascii(word) * 5 + length(word) * 3) % 201 - 100 AS DOUBLE) / {dbl(100.0)} AS c
          FROM (SELECT DISTINCT unnest({TOK}) AS word FROM benchmark)
        ), t AS (SELECT doc_id, unnest({TOK}) AS word FROM documents),
        s AS (SELECT doc_id, avg(CASE WHEN odd = 0 THEN c END) AS a, avg(CASE WHEN odd = 1 THEN c END) AS b
              FROM t JOIN w USING (word) GROUP BY doc_id)
        SELECT doc_id, round((a + {dbl(1.0)}) / {dbl(2.0)}, 6) AS p1, round((b + {dbl(1.0)}) / {dbl(2.0)}, 6) AS p2
        FROM documents LEFT JOIN s USING (doc_id)""",
    "lexicon_sentiment": f"""WITH {LEX_SQL}
        SELECT doc_id, round(v, 6) AS lyric_valence, round(a, 6) AS lyric_arousal, hits AS lex_hits FROM lexagg""",
    "lexicon_own_words": f"""WITH toks AS (SELECT doc_id, unnest({TOK}) AS word FROM documents),
        h AS (SELECT doc_id, CAST(ascii(word) % 10 AS DOUBLE) AS v, CAST(length(word) % 7 AS DOUBLE) AS a FROM toks WHERE length(word) % 3 <> 0)
        SELECT d.doc_id, round(avg(h.v), 6) AS lyric_valence, round(avg(h.a), 6) AS lyric_arousal, count(h.v) AS lex_hits
        FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id GROUP BY d.doc_id""",
    "sentiment_fallback": f"""WITH {LEX_SQL}, cache AS (
          SELECT doc_id,
                 CASE WHEN lang = 'es' THEN 'n/a' ELSE CAST(CAST(n_chars % 100 AS DOUBLE) / {dbl(100.0)} AS VARCHAR) END AS cv_raw,
                 CASE WHEN lang <> 'de' THEN CAST(n_chars % 89 AS DOUBLE) / {dbl(100.0)} END AS ca
          FROM documents WHERE source IN {CACHED_SOURCES}
        ), c2 AS (
          SELECT doc_id, CASE WHEN regexp_matches(trim(cv_raw), '{_NUM_RE}') THEN TRY_CAST(trim(cv_raw) AS DOUBLE) END AS cv, ca
          FROM cache
        ), sc AS (
          SELECT doc_id, {_resc_sql('quality', P1_POLARITY)} AS p1, {_resc_sql('toxic', P2_POLARITY)} AS p2 FROM labels
        ), j AS (
          SELECT d.doc_id, {_strip('d.text')} <> '' AS ok, l.v, l.a, c2.cv, c2.ca,
                 CASE WHEN {_strip('d.text')} <> '' THEN sc.p1 END AS p1,
                 CASE WHEN {_strip('d.text')} <> '' THEN sc.p2 END AS p2
          FROM documents d JOIN lexagg l ON l.doc_id = d.doc_id
          LEFT JOIN c2 ON c2.doc_id = d.doc_id LEFT JOIN sc ON sc.doc_id = d.doc_id
        )
        SELECT doc_id,
          round(CASE WHEN cv IS NOT NULL AND ca IS NOT NULL THEN cv
               ELSE coalesce(v, CASE WHEN p1 <> 0 THEN p1 END, p2) END, 6) AS lyric_valence,
          round(CASE WHEN cv IS NOT NULL AND ca IS NOT NULL THEN ca ELSE a END, 6) AS lyric_arousal,
          CASE WHEN cv IS NOT NULL AND ca IS NOT NULL THEN 'cache' WHEN v IS NOT NULL THEN 'lexicon'
               WHEN p1 <> 0 THEN 'scorer1' WHEN p2 IS NOT NULL THEN 'scorer2' END AS sentiment_source
        FROM j""",
    "lyric_status": f"""SELECT doc_id, {_wc('text')} AS word_count, {_status_sql('text')} AS lyrics_status FROM documents""",
    "lyric_status_counts": f"""SELECT lyrics_status, count(*) AS n_rows
        FROM (SELECT {_status_sql('text')} AS lyrics_status FROM documents) GROUP BY lyrics_status""",
    "lyric_report": f"""SELECT * FROM (SELECT doc_id, {_status_sql('text')} AS lyrics_status, {_wc('text')} AS word_count
        FROM documents) WHERE lyrics_status IN ('SHORT', 'SUMMARY', 'MISSING', 'INSTRUMENTAL')""",
    "clean_lyrics_fetch": f"""SELECT conv_id, turn, coalesce({_strip(
        "regexp_replace(regexp_replace(regexp_replace(text, '(?mi)^.*(" + '|'.join(FETCH_WORDS) + ").*$', '', 'g'), '\\[.*?\\]', ' ', 'g'), '\\s+', ' ', 'g')")}, '') AS lyrics
        FROM conversations""",
    "clean_lyrics_gate": f"""SELECT doc_id, {_strip(
        "regexp_replace(regexp_replace(regexp_replace(text, '(?is)(^|" + NB + ")[0-9]+\\s+this[\\s\\S]*', '\\1', 'g'), "
        "'(?is)Version[\\s\\S]*', '', 'g'), '(?is)THE!! [0-9]+(?:\\s+THE!! [0-9]+)*', '', 'g')")} AS lyrics
        FROM documents""",
    "mojibake_repair": f"""WITH c AS (SELECT doc_id, text, {_corrupt_sql('text')} AS bad FROM documents)
        SELECT doc_id, ({_telltale_sql('bad')}) AS mojibake,
               CASE WHEN {_telltale_sql('bad')} THEN text ELSE bad END AS repaired,
               (CASE WHEN {_telltale_sql('bad')} THEN text ELSE bad END) = text AS restored
        FROM c""",
    "song_keys": f"""WITH s AS (
          SELECT p_partkey, {_title_sql()} AS title,
                 CASE WHEN p_size % 3 = 0 THEN ' ' || p_brand || ' ' ELSE upper(p_brand) END AS artist
          FROM part)
        SELECT p_partkey, title, artist,
          lower(trim(regexp_replace(regexp_replace(title,
              '{C.KEY_TITLE_DROP_PATTERN}', '', 'gi'),
              '\\s+', ' ', 'g')) || '|||' || trim(regexp_replace(artist, '\\s+', ' ', 'g'))) AS enrich_key,
          lower(trim(title)) || '|||' || lower(trim(artist)) AS lyrics_key,
          trim(title) || '|||' || trim(artist) AS answer_key,
          lower(trim(title)) AS title_norm, lower(trim(artist)) AS artist_norm,
          'track:"' || trim(title) || '" artist:"' || trim(artist) || '"' AS search_text,
          trim(title) || ' ' || trim(artist) AS search_words
        FROM s""",
}

QUERIES = {
    "lyrics_lookup": q_lyrics_lookup,
    "polarity_scorers": q_polarity_scorers,
    "lexicon_sentiment": q_lexicon_sentiment,
    "lexicon_own_words": q_lexicon_own_words,
    "sentiment_fallback": q_sentiment_fallback,
    "lyric_status": q_lyric_status,
    "lyric_status_counts": q_lyric_status_counts,
    "lyric_report": q_lyric_report,
    "clean_lyrics_fetch": q_clean_lyrics_fetch,
    "clean_lyrics_gate": q_clean_lyrics_gate,
    "mojibake_repair": q_mojibake_repair,
    "song_keys": q_song_keys,
}
