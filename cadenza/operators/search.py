"""Lookup by the free search form ``title artist`` (JOI-2, FN-S14).

A catalogue entry answers a search if its name and artists hold all of the
search's words; of several the one with the least rank is the hit.  The plan is
an inverted index: every search meets the entries of its rarest word only, and
the rest of its words is tested there.

Equal word sets are one search and one entry, whatever number of rows has them.
The entries of a word are dealt into blocks of about ``block_rows``; a search is
sent to each block of its word and the blocks' least ranks are aggregated, so a
word that every entry has is spread over tasks.  Work: one test for each search
and entry of its rarest word; only matches leave the join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .common import lookup_join, materialised
from .resolve import clean_song_list

WORD = r"[\p{L}\p{N}]+"


def word_set(*cols) -> Column:
    """The different words (runs of letters and digits, lower case) of all ``cols``, sorted; NULLs have none."""
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", *cols)), F.lit(WORD), F.lit(0))
    return F.sort_array(F.array_distinct(words))


def _entries(catalog: DataFrame, rank: list[Column]) -> DataFrame:
    return catalog.select(
        word_set(F.col("name"), text.join_names("artists", sep=" ")).alias("_words"),
        F.struct(*rank).alias("_rank"),
        F.col("id").alias("track_id"),
        F.col("external_urls")["spotify"].alias("source_link"),
        F.col("name").alias("found_title"),
        text.join_names("artists").alias("found_artists"))


def rarest_words(searches: DataFrame, freq: DataFrame) -> DataFrame:
    """(_q, word, n): of each search (``_q``, an array of words) its word with the fewest entries ``n``,
    ties by the word.  Searches with a word that no entry has go."""
    each = searches.select("_q", F.explode("_q").alias("word"))
    known = lookup_join(each, freq, ["word"], "inner")
    least = known.groupBy("_q").agg(F.count(F.lit(1)).alias("n_known"), F.min(F.struct("n", "word")).alias("least"))
    return least.where(F.col("n_known") == F.size("_q")).select("_q", "least.word", "least.n")


def best_entries(searches: DataFrame, sets: DataFrame, block_rows: int) -> DataFrame:
    """(_q, _rank): the least rank of the ``sets`` (_words, _rank) that hold all words of a search."""
    postings = sets.select("_words", "_rank", F.explode("_words").alias("word"))
    freq = postings.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    anchors = rarest_words(searches, freq)
    blocks = F.ceil(F.col("n") / F.lit(block_rows)).cast("long")
    asked = anchors.select("_q", "word", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_block"))
    wanted = anchors.select("word", "n").distinct()
    dealt = lookup_join(postings, wanted, ["word"], "inner").select(
        "word", "_words", "_rank", F.pmod(F.xxhash64("_words"), blocks).alias("_block"))
    holds = F.size(F.array_except("_q", "_words")) == 0
    a, d = asked.alias("a"), dealt.alias("d")
    met = a.join(d, (F.col("a.word") == F.col("d.word")) & (F.col("a._block") == F.col("d._block")) & holds)
    return met.groupBy("_q").agg(F.min("_rank").alias("_rank"))


def search_tracks(songs: DataFrame, catalog: DataFrame, rank: list[Column], title: str = "title",
                  artist: str = "artist", block_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(hits, not_found) of the searches ``title artist``.

    ``songs`` and ``catalog`` as for ``resolve_tracks``; ``rank`` is unique.  hits: song columns +
    track_id, source_link, found_title, found_artists.  not_found: song columns + ``search``, the text.
    Rows with a blank title or artist are no searches and are in neither; a search without any word
    (punctuation only) is not found.  Repeated songs are all answered."""
    s = clean_song_list(songs, title, artist).withColumn("_words", word_set(title, artist))
    entries = _entries(catalog, rank)
    sets = materialised(entries.where(F.size("_words") > 0).groupBy("_words").agg(F.min("_rank").alias("_rank")),
                        "search_sets")
    searches = s.where(F.size("_words") > 0).select(F.col("_words").alias("_q")).distinct()
    best = materialised(best_entries(searches, sets, block_rows).withColumnRenamed("_q", "_words"), "search_best")
    hits = lookup_join(lookup_join(s, best, ["_words"], "inner").drop("_words"),
                       entries.drop("_words"), ["_rank"], "inner").drop("_rank")
    missing = lookup_join(s, best.select("_words"), ["_words"], "left_anti").drop("_words")
    return hits, missing.withColumn("search", text.search_words(title, artist))
