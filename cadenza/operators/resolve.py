"""Catalog resolution and feature lookups (PRJ-1, JOI-2..5, WIN-2, FN-P8,
FN-S12, NUM-6, PRJ-12, JOI-13).

Provider calls of the original become joins against provider tables with one
row per key: the least rank of each key is aggregated (narrow rows), and its
row comes back by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import num, text
from .common import lookup_join, one_per_key
from .merge import first_per_key


def clean_song_list(songs: DataFrame, title: str = "title", artist: str = "artist") -> DataFrame:
    """Strip title/artist and keep rows where both are non-empty (NULL is
    treated as blank and dropped)."""
    s = songs.withColumns({title: text.strip(title), artist: text.strip(artist)})
    return s.where((F.coalesce(F.col(title), F.lit("")) != "") &
                   (F.coalesce(F.col(artist), F.lit("")) != ""))


def catalog_top_hits(catalog: DataFrame, rank: list[Column]) -> DataFrame:
    """Best catalog entry per normalised (name, first artist) search key; ``rank``
    is unique.

    ``catalog``: id, external_urls.spotify, name, artists[].name.  Output:
    _k1, _k2, track_id, source_link, found_title, found_artists."""
    hits = catalog.select(
        text.merge_norm("name").alias("_k1"),
        text.merge_norm(F.get(F.col("artists"), 0)["name"]).alias("_k2"),
        F.struct(*rank).alias("_rank"),
        F.col("id").alias("track_id"),
        F.col("external_urls")["spotify"].alias("source_link"),
        F.col("name").alias("found_title"),
        text.join_names("artists").alias("found_artists"))
    return one_per_key(hits, ["_k1", "_k2"], "_rank").drop("_rank")


def resolve_tracks(songs: DataFrame, catalog: DataFrame, rank: list[Column],
                   title: str = "title", artist: str = "artist") -> tuple[DataFrame, DataFrame]:
    """(hits, not_found).  hits: song columns + track_id, source_link,
    found_title, found_artists for songs with a catalog entry; not_found:
    song columns + ``line`` = 'title - artist' for the rest."""
    s = clean_song_list(songs, title, artist).withColumns(
        {"_k1": text.merge_norm(title), "_k2": text.merge_norm(artist)})
    top = catalog_top_hits(catalog, rank)
    hits = lookup_join(s, top, ["_k1", "_k2"], "inner").drop("_k1", "_k2")
    missing = (lookup_join(s, top.select("_k1", "_k2"), ["_k1", "_k2"], "left_anti").drop("_k1", "_k2")
               .withColumn("line", F.concat_ws(" - ", F.col(title), F.col(artist))))
    return hits, missing


def features_with_fallback(hits: DataFrame, features: DataFrame, analysis: DataFrame,
                           id_col: str = "track_id", features_order: str | None = None,
                           analysis_order: str | None = None) -> DataFrame:
    """Per hit: the primary features row if one exists (its values as they
    are, NULL tempo included), else the fallback analysis row (valence
    NULL), else NULLs.  Row-level choice, not per-column coalesce.

    ``features``: id, tempo, mode (1/0), valence.  ``analysis``: id,
    track struct<tempo, mode>.  Adds bpm, mode, valence, features_source.

    One lookup per hit, as many rows out as hits: of several rows of an id the
    one with the least order column counts (unique per id), without such a
    column the least row."""
    features = one_lookup_row(features, id_col, features_order)
    analysis = one_lookup_row(analysis, id_col, analysis_order)
    f = features.select(F.col(id_col), F.lit(True).alias("_has_f"),
                        F.col("tempo").alias("_f_tempo"), F.col("mode").alias("_f_mode"),
                        F.col("valence").alias("_f_val"))
    a = analysis.select(F.col(id_col), F.lit(True).alias("_has_a"),
                        F.col("track")["tempo"].alias("_a_tempo"),
                        F.col("track")["mode"].alias("_a_mode"))
    j = lookup_join(lookup_join(hits, f, [id_col]), a, [id_col])
    has_f = F.col("_has_f").isNotNull()
    has_a = F.col("_has_a").isNotNull()
    out = j.withColumns({
        "bpm": F.when(has_f, F.col("_f_tempo")).when(has_a, F.col("_a_tempo")).cast("double"),
        "mode": F.when(has_f, num.mode_from_int(F.col("_f_mode")))
                 .when(has_a, num.mode_from_int(F.col("_a_mode"))),
        "valence": F.when(has_f, F.col("_f_val")).cast("double"),
        "features_source": F.when(has_f, F.lit("features")).when(has_a, F.lit("analysis")),
    })
    return out.drop("_has_f", "_f_tempo", "_f_mode", "_f_val", "_has_a", "_a_tempo", "_a_mode")


def one_lookup_row(table: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """At most one row per key (rows without a key match nothing and go): by ``order_col``,
    else the least row, column by column."""
    table = table.where(F.col(key).isNotNull())
    if order_col is not None:
        return one_per_key(table, [key], order_col)
    rest = [c for c in table.columns if c != key]
    return table.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in rest])


def failed_ids(hits: DataFrame, features: DataFrame, analysis: DataFrame,
               id_col: str = "track_id") -> DataFrame:
    """Hits with neither a features row nor an analysis row (a row whose
    values are all NULL still counts as found)."""
    left = lookup_join(hits.select(id_col), features.select(id_col), [id_col], "left_anti")
    return lookup_join(left, analysis.select(id_col), [id_col], "left_anti")


def known_ids(ids: DataFrame, features: DataFrame, id_col: str = "track_id",
              value_cols=("tempo", "mode", "valence"), order_col: str | None = None) -> DataFrame:
    """For a list of ids: the feature values (of several rows of an id as in
    ``one_lookup_row``) and whether a row was found."""
    f = one_lookup_row(features, id_col, order_col).select(id_col, *value_cols).withColumn("_found", F.lit(True))
    j = lookup_join(ids, f, [id_col])
    return j.withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found")


def upsert_cache(old: DataFrame, new: DataFrame, key: str, order_col: str) -> DataFrame:
    """New cache snapshot: the last new row per key (by ``order_col``) wins,
    keys only in ``old`` are kept; NULL-valued results are stored too.
    Adds ``origin`` = old/new."""
    latest = first_per_key(new, [key], order_col, last=True).drop(order_col)
    kept = lookup_join(old, latest.select(key), [key], "left_anti")
    cols = [c for c in latest.columns]
    return (kept.select(*cols).withColumn("origin", F.lit("old"))
            .unionByName(latest.withColumn("origin", F.lit("new"))))
