"""Lexicon sentiment (JOI-9, AGG-3), fallbacks (NUM-5, INF-1) and reuse of
cached scores (JOI-11).

The lexicon is written once to the shared folder, so the planner knows its
real size: tokens, exploded in the scan stage, are probed against a broadcast
of it while it is under Spark's own threshold; beyond, common words alone are, and the others filtered and joined
by shuffle; one row per document leaves the aggregation.  Cached scores and fallback
scores are joined after that, so no text is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import num, text
from .common import fits_broadcast, lookup_join, materialised
from .resolve import one_lookup_row


def lexicon_scores(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                   carry: list[str] | None = None, shuffled: bool | None = None) -> DataFrame:
    """Per document: mean valence and mean arousal of its tokens found in the
    lexicon (token multiplicity kept), and the number of hits.  Documents
    without hits get NULL means.  ``lexicon`` has unique ``word`` with
    ``valence``/``arousal``.  ``carry`` columns are passed through.

    A lexicon under Spark's broadcast threshold (or ``shuffled`` False) meets the tokens
    where they are read.  Of a larger one (or ``shuffled`` True) only the documents' most common words do
    (``common_words``), which most tokens are; the other tokens, but those that a Bloom filter of the lexicon
    excludes, are joined by word."""
    carry = carry or []
    lex = materialised(lexicon.select("word", F.col("valence").cast("double").alias("valence"),
                                      F.col("arousal").cast("double").alias("arousal")), "lexicon")
    if shuffled is None:
        shuffled = not fits_broadcast(lex)
    if not shuffled:
        exploded = docs.select(id_col, *carry, F.explode_outer(text.tokens(text_col)).alias("word"))
        firsts = [F.first(c).alias(c) for c in carry]
        return exploded.join(lex, "word", "left").groupBy(id_col).agg(
            F.avg("valence").alias("lex_valence"), F.avg("arousal").alias("lex_arousal"),
            F.count("valence").alias("lex_hits"), *firsts)
    may = word_filter(lex)
    words = docs.select(F.col(id_col).alias("_id"), F.explode(text.tokens(text_col)).alias("word")).where(may("word"))
    common = common_words(words)
    held = lex.join(F.broadcast(common), "word")
    common = F.broadcast(common)
    rest = lookup_join(words.join(common, "word", "left_anti"), lex, ["word"], "inner")
    found = rest.select(F.col("_id").alias(id_col), *(F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in carry), F.lit(False).alias("_doc"),
                        "valence", "arousal")
    exploded = docs.select(id_col, *carry, F.lit(True).alias("_doc"), F.explode_outer(text.tokens(text_col)).alias("word"))
    met = exploded.join(F.broadcast(held), "word", "left").drop("word")
    firsts = [F.max(F.when(F.col("_doc"), F.col(c))).alias(c) for c in carry]
    return met.unionByName(found).groupBy(id_col).agg(
        F.avg("valence").alias("lex_valence"), F.avg("arousal").alias("lex_arousal"), F.count("valence").alias("lex_hits"), *firsts)


COMMON_WORDS = 1 << 16     # that are broadcast at most
COMMON_BYTES = 64          # of each of them


def common_words(words: DataFrame, most: int = COMMON_WORDS) -> DataFrame:
    """(word) of the most common ``word`` of ``words``, all that occur 2^k times or more for the least k that
    gives no more than ``most``.  All rows are counted."""
    counts = words.where(F.octet_length("word") <= COMMON_BYTES).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = materialised(counts.select("word", F.floor(F.log2("n")).cast("int").alias("k")), "word-counts")
    least, held = 64, 0
    for r in counts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("k")).collect():     # a row for each power of two
        held += r["n"]
        if held > most:
            break
        least = r["k"]
    return materialised(counts.where(F.col("k") >= least).select("word"), "common-words")


FILTER_BITS = 1 << 20      # of the Bloom filter; its size doesn't grow with the lexicon
FILTER_HASHES = 2


def word_filter(words: DataFrame, bits: int = FILTER_BITS):
    """A test ``column name -> Column`` that holds for every ``word`` of ``words`` and for few others: a Bloom
    filter as a literal array of ``bits`` / 32 integers.  A lexicon of many more words than bits fills it, and
    it then lets everything through."""
    def places(c):
        return [F.pmod(F.xxhash64(F.col(c), F.lit(k)), F.lit(bits)) for k in range(FILTER_HASHES)]

    set_ = words.select(F.explode(F.array(*places("word"))).alias("p")).groupBy(F.shiftright("p", 5).cast("int").alias("slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(31).cast("int"))).alias("m"))
    table = [0] * (bits // 32)
    for r in set_.collect():           # bits / 32 rows at most
        table[r["slot"]] = r["m"]
    # one string, which the optimizer folds to an array
    literal = F.split(F.lit(" ".join(map(str, table))), " ").cast("array<bigint>")

    def test(c: str):
        ok = F.lit(True)
        for p in places(c):
            word = F.get(literal, F.shiftright(p, 5).cast("int"))
            ok = ok & (F.call_function("shiftright", word, p.bitwiseAND(31).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1)
        return ok
    return test


def lyric_sentiment(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                    scores: DataFrame | None = None,
                    cache: DataFrame | None = None) -> DataFrame:
    """Valence/arousal per document with the reference's rules.

    * ``cache`` (``id_col, cached_valence, cached_arousal``): used only when
      both cached values are numeric; otherwise both are recomputed.
    * valence: lexicon mean, else scorer 1 unless it is 0/missing, else
      scorer 2; arousal: lexicon mean only.
    * ``scores`` (``id_col, p1, p2``): fallback scorer outputs on the 0..1
      scale (INF-1); they count only for non-blank text.

    Side tables have one row per id (of several, the least counts) and are
    joined to the per-document rows; the text is never shuffled.
    """
    base = docs.select(id_col, text_col, text.not_missing(text_col).alias("_text_ok"))
    agg = lexicon_scores(base, id_col, text_col, lexicon, carry=["_text_ok"])
    none = F.lit(None).cast("double")
    if cache is not None:
        c = cache.select(id_col, num.coerce_number("cached_valence").alias("_cv"),
                         num.coerce_number("cached_arousal").alias("_ca"))
        agg = lookup_join(agg, one_lookup_row(c, id_col), [id_col])
    else:
        agg = agg.withColumns({"_cv": none, "_ca": none})
    if scores is not None:
        s = scores.select(id_col, F.col("p1").alias("_p1"), F.col("p2").alias("_p2"))
        agg = lookup_join(agg, one_lookup_row(s, id_col), [id_col])
    else:
        agg = agg.withColumns({"_p1": none, "_p2": none})
    ok = F.col("_text_ok")
    p1 = F.when(ok, F.col("_p1"))
    p2 = F.when(ok, F.col("_p2"))
    reuse = F.col("_cv").isNotNull() & F.col("_ca").isNotNull()
    lex_v, lex_a = F.col("lex_valence"), F.col("lex_arousal")
    fresh_v = num.sentiment_fallback(lex_v, p1, p2)
    source = (F.when(reuse, F.lit("cache"))
              .when(lex_v.isNotNull(), F.lit("lexicon"))
              .when(num.zero_to_null(p1).isNotNull(), F.lit("scorer1"))
              .when(p2.isNotNull(), F.lit("scorer2")))
    return agg.select(
        id_col,
        F.when(reuse, F.col("_cv")).otherwise(fresh_v).alias("lyric_valence"),
        F.when(reuse, F.col("_ca")).otherwise(lex_a).alias("lyric_arousal"),
        source.alias("sentiment_source"))


def lyrics_lookup(tracks: DataFrame, key: str, cache: DataFrame | None = None,
                  source: DataFrame | None = None, line_words=None) -> DataFrame:
    """Lyrics per track (JOI-10): a cached non-empty text as is, else the
    fetched text (``source``: key, lyrics) cleaned by the fetch cleaner when
    it is non-empty, else ''.  A key that a side table has several times counts
    once (the least text).  Adds ``lyrics`` and ``lyrics_origin``."""
    null = F.lit(None).cast("string")
    t = tracks
    for side, col, out in ((cache, "lyrics", "_cached"), (source, "lyrics", "_fetched")):
        if side is None:
            t = t.withColumn(out, null)
        else:
            t = lookup_join(t, one_lookup_row(side.select(key, F.col(col).alias(out)), key), [key])
    cached = F.when(F.col("_cached") != "", F.col("_cached"))
    clean = (text.clean_lyrics_fetch(F.col("_fetched"), line_words) if line_words is not None
             else text.clean_lyrics_fetch(F.col("_fetched")))
    fetched = F.when(F.col("_fetched") != "", clean)
    return t.withColumns({
        "lyrics": F.coalesce(cached, fetched, F.lit("")),
        "lyrics_origin": F.when(cached.isNotNull(), F.lit("cache"))
                          .when(fetched.isNotNull(), F.lit("fetched")).otherwise(F.lit("none")),
    }).drop("_cached", "_fetched")


def polarity_scores(docs: DataFrame, id_col: str, text_col: str, polarity_lexicon: DataFrame,
                    out: str = "p1") -> DataFrame:
    """A fallback scorer built from a polarity lexicon (INF-1): the mean
    polarity (-1..1) of a document's lexicon tokens, rescaled to 0..1
    (``(c + 1) / 2``); documents without hits get NULL.  ``polarity_lexicon``:
    word, polarity.  Output (id, ``out``) feeds ``lyric_sentiment(scores=)``."""
    lex = polarity_lexicon.select("word", F.col("polarity").cast("double").alias("valence"),
                                  F.col("polarity").cast("double").alias("arousal"))
    s = lexicon_scores(docs, id_col, text_col, lex)
    return s.select(id_col, num.rescale_polarity(F.col("lex_valence")).alias(out))
