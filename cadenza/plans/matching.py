"""Join plans over the driver tables: part plays both the song list and the
catalog/result tables, orders and lineitem the feature providers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import num, text
from ..operators.merge import merge_back
from ..operators.resolve import (failed_ids, features_with_fallback, known_ids, resolve_tracks,
                                 upsert_cache)
from ..operators.search import search_tracks
from .base import load, round_doubles
from .scoring import MODE_BY_TYPE, _case

RUN_DATE = "2024-01-01"
CATALOG_TYPES = ("PROMO", "STANDARD")
NULL_ARTIST_SIZE = 13


def _artist(c):
    return F.when(F.col("p_size") != NULL_ARTIST_SIZE, c)


def q_merge_back(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    songs = part.select(F.col("p_partkey").alias("_row"), F.col("p_name").alias("title"),
                        _artist(F.col("p_brand")).alias("artist"))
    final = part.where(F.col("p_size") <= 25).select(
        F.col("p_partkey").alias("final_row"),
        F.concat(F.lit("  "), F.upper("p_name")).alias("title"),
        _artist(F.concat(F.lower("p_brand"), F.lit(" "))).alias("artist"),
        "p_type", "p_retailprice")
    out = merge_back(songs, final, ("title", "artist"), final_order="final_row", run_date=RUN_DATE)
    return round_doubles(out.drop("final_row"))


def _catalog(part):
    return part.where(F.col("p_type").isin(*CATALOG_TYPES)).select(
        F.concat(F.lit("trk"), F.col("p_partkey").cast("string")).alias("id"),
        F.struct(F.concat(F.lit("https://open.example.net/track/trk"),
                          F.col("p_partkey").cast("string")).alias("spotify")).alias("external_urls"),
        F.col("p_name").alias("name"),
        F.array(F.struct(F.col("p_brand").alias("name")),
                F.struct(F.col("p_type").alias("name"))).alias("artists"),
        "p_retailprice", "p_partkey")


def _songs(part):
    return part.where(~F.col("p_type").isin(*CATALOG_TYPES)).select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, F.upper("p_name"))
         .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("title"),
        F.when(F.col("p_size") != NULL_ARTIST_SIZE, F.col("p_brand")).alias("artist"))


def _resolved(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return resolve_tracks(_songs(part), _catalog(part), [F.col("p_retailprice"), F.col("p_partkey")])


def q_catalog_hits(spark, sf_dir):
    return _resolved(spark, sf_dir)[0]


def q_not_found(spark, sf_dir):
    return _resolved(spark, sf_dir)[1].select("p_partkey", "line")


def _searched(spark, sf_dir):
    """Searches with the last word of a name or all of it, by brand or by brand and type."""
    part = load(spark, sf_dir, "part")
    songs = part.where(~F.col("p_type").isin(*CATALOG_TYPES)).select(
        "p_partkey",
        F.when(F.col("p_size") % 3 == 0, F.upper(F.element_at(F.split("p_name", " "), -1)))
         .otherwise(F.col("p_name")).alias("title"),
        F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("promo, "), F.col("p_brand")))
         .when(F.col("p_size") != NULL_ARTIST_SIZE, F.col("p_brand")).alias("artist"))
    return search_tracks(songs, _catalog(part), [F.col("p_retailprice"), F.col("p_partkey")])


def q_search_hits(spark, sf_dir):
    return _searched(spark, sf_dir)[0]


def q_search_not_found(spark, sf_dir):
    return _searched(spark, sf_dir)[1].select("p_partkey", "search")


def _providers(spark, sf_dir):
    """Every order and line item: several feature rows for a customer key and several
    analysis rows for an even part key; the odd keys without a customer have neither."""
    orders = load(spark, sf_dir, "orders")
    lineitem = load(spark, sf_dir, "lineitem")
    features = orders.select(
        F.col("o_custkey").alias("track_id"), F.col("o_orderkey").alias("f_order"),
        F.when(F.col("o_orderpriority") != "5-LOW",
               (F.lit(60) + F.col("o_orderkey") % 100).cast("double")).alias("tempo"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"), F.lit(1))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit(0)).otherwise(F.lit(2)).alias("mode"),
        ((F.col("o_orderkey") % 10).cast("double") / F.lit(10.0)).alias("valence"))
    analysis = lineitem.select(
        (F.col("l_partkey") * 2).alias("track_id"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("a_order"),
        F.struct((F.col("l_quantity") * F.lit(2.0)).alias("tempo"),
                 F.when(F.col("l_returnflag") == "R", F.lit(1))
                  .when(F.col("l_returnflag") == "A", F.lit(0)).alias("mode")).alias("track"))
    return features, analysis


def _hits(spark, sf_dir):
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("track_id"), "p_name")


def q_features_fallback(spark, sf_dir):
    features, analysis = _providers(spark, sf_dir)
    return round_doubles(features_with_fallback(_hits(spark, sf_dir), features, analysis,
                                                features_order="f_order", analysis_order="a_order"))


def q_failed_ids(spark, sf_dir):
    features, analysis = _providers(spark, sf_dir)
    return failed_ids(_hits(spark, sf_dir), features, analysis)


KNOWN_IDS = (3, 17, 4242, 10**12)


def q_known_ids(spark, sf_dir):
    features, _ = _providers(spark, sf_dir)
    ids = spark.createDataFrame([(i,) for i in KNOWN_IDS], "track_id bigint")
    feats = features.where(F.col("track_id").isin(*KNOWN_IDS)).withColumn("mode", num.mode_from_int(F.col("mode")))
    return round_doubles(known_ids(ids, feats, order_col="f_order"))


def q_cache_upsert(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    key = text.enrich_key("p_name", "p_brand").alias("song_key")
    old = part.where(F.col("p_type").isin("ECONOMY", "MEDIUM", "SMALL")).select(
        key, (F.lit(40) + F.lit(2) * F.col("p_size")).cast("double").alias("bpm"),
        _case(F.col("p_type"), MODE_BY_TYPE).alias("mode"), F.col("p_partkey").alias("_row"))
    old = old.groupBy("song_key").agg(F.max_by(F.struct("bpm", "mode"), "_row").alias("v")) \
             .select("song_key", "v.bpm", "v.mode")
    new = part.where(F.col("p_type").isin("MEDIUM", "LARGE", "PROMO", "STANDARD")).select(
        key, F.when(F.col("p_size") <= 45, (F.lit(50) + F.col("p_size")).cast("double")).alias("bpm"),
        F.when(F.col("p_type") == "LARGE", F.lit("Minor")).otherwise(F.lit("Major")).alias("mode"),
        F.col("p_partkey").alias("_row"))
    return round_doubles(upsert_cache(old, new, "song_key", "_row"))


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

def _mode_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODE_BY_TYPE.items())
    return f"CASE p_type {whens} END"


_PROVIDERS_SQL = """features AS (
      SELECT * FROM (
        SELECT o_custkey AS track_id,
             CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(60 + o_orderkey % 100 AS DOUBLE) END AS tempo,
             CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 2 END AS mode,
             CAST(o_orderkey % 10 AS DOUBLE) / 10.0::DOUBLE AS valence,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
        FROM orders) WHERE rn = 1
    ), analysis AS (
      SELECT * FROM (
        SELECT l_partkey * 2 AS track_id, l_quantity * 2.0::DOUBLE AS tempo,
             CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS mode,
             row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 100 + l_linenumber) AS rn
        FROM lineitem) WHERE rn = 1
    )"""

_SEARCH_SQL = f"""cat AS (
          SELECT *, p_brand || ', ' || p_type AS found_artists,
                 list_distinct(regexp_extract_all(lower(p_name || ' ' || p_brand || ' ' || p_type), '[\\p{{L}}\\p{{N}}]+')) AS words
          FROM part WHERE p_type IN {CATALOG_TYPES}
        ), songs AS (
          SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN upper(string_split(p_name, ' ')[-1]) ELSE p_name END AS title,
                 CASE WHEN p_size % 4 = 0 THEN 'promo, ' || p_brand WHEN p_size <> {NULL_ARTIST_SIZE} THEN p_brand END AS artist
          FROM part WHERE p_type NOT IN {CATALOG_TYPES}
        ), searches AS (
          SELECT title, artist, list_distinct(regexp_extract_all(lower(title || ' ' || artist), '[\\p{{L}}\\p{{N}}]+')) AS words
          FROM songs WHERE title <> '' AND artist <> '' GROUP BY title, artist
        ), top AS (
          SELECT s.title, s.artist, arg_min(c.p_partkey, (c.p_retailprice, c.p_partkey)) AS hit
          FROM searches s JOIN cat c ON list_has_all(c.words, s.words) GROUP BY s.title, s.artist
        )"""

ORACLE = {
    "search_hits": f"""WITH {_SEARCH_SQL}
        SELECT s.p_partkey, s.title, s.artist, 'trk' || c.p_partkey AS track_id,
               'https://open.example.net/track/trk' || c.p_partkey AS source_link, c.p_name AS found_title, c.found_artists
        FROM songs s JOIN top t ON s.title = t.title AND s.artist = t.artist JOIN cat c ON c.p_partkey = t.hit""",
    "search_not_found": f"""WITH {_SEARCH_SQL}
        SELECT p_partkey, title || ' ' || artist AS search FROM songs s
        WHERE title <> '' AND artist <> '' AND NOT EXISTS (SELECT 1 FROM top t WHERE t.title = s.title AND t.artist = s.artist)""",
    "merge_back": f"""WITH songs AS (
          SELECT p_partkey AS _row, p_name AS title, CASE WHEN p_size <> {NULL_ARTIST_SIZE} THEN p_brand END AS artist FROM part
        ), final AS (
          SELECT p_partkey AS final_row, '  ' || upper(p_name) AS title,
                 CASE WHEN p_size <> {NULL_ARTIST_SIZE} THEN lower(p_brand) || ' ' END AS artist, p_type, p_retailprice
          FROM part WHERE p_size <= 25
        ), fd AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(title)), lower(trim(artist)) ORDER BY final_row) AS rn FROM final) WHERE rn = 1
        )
        SELECT s._row, s.title, s.artist, f.title AS title_new, f.artist AS artist_new, f.p_type,
               round(f.p_retailprice, 6) AS p_retailprice, 'You' AS curator, '{RUN_DATE}' AS date_added
        FROM songs s LEFT JOIN fd f
          ON lower(trim(s.title)) IS NOT DISTINCT FROM lower(trim(f.title))
         AND lower(trim(s.artist)) IS NOT DISTINCT FROM lower(trim(f.artist))""",
    "catalog_hits": f"""WITH cat AS (
          SELECT 'trk' || p_partkey AS track_id, 'https://open.example.net/track/trk' || p_partkey AS source_link,
                 p_name AS found_title, p_brand || ', ' || p_type AS found_artists,
                 lower(trim(p_name)) AS k1, lower(trim(p_brand)) AS k2, p_retailprice, p_partkey
          FROM part WHERE p_type IN {CATALOG_TYPES}
        ), top AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY p_retailprice, p_partkey) AS rn FROM cat) WHERE rn = 1
        ), songs AS (
          SELECT p_partkey, trim(CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE ' ' || p_name || ' ' END) AS title,
                 CASE WHEN p_size <> {NULL_ARTIST_SIZE} THEN p_brand END AS artist
          FROM part WHERE p_type NOT IN {CATALOG_TYPES}
        )
        SELECT s.p_partkey, s.title, s.artist, t.track_id, t.source_link, t.found_title, t.found_artists
        FROM songs s JOIN top t ON lower(s.title) = t.k1 AND lower(s.artist) = t.k2
        WHERE s.title <> '' AND s.artist <> ''""",
    "not_found": f"""WITH songs AS (
          SELECT p_partkey, trim(CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE ' ' || p_name || ' ' END) AS title,
                 CASE WHEN p_size <> {NULL_ARTIST_SIZE} THEN p_brand END AS artist
          FROM part WHERE p_type NOT IN {CATALOG_TYPES}
        )
        SELECT p_partkey, title || ' - ' || artist AS line FROM songs s
        WHERE coalesce(title, '') <> '' AND coalesce(artist, '') <> ''
          AND NOT EXISTS (SELECT 1 FROM part c WHERE c.p_type IN {CATALOG_TYPES}
                          AND lower(trim(c.p_name)) = lower(s.title) AND lower(trim(c.p_brand)) = lower(s.artist))""",
    "features_fallback": f"""WITH {_PROVIDERS_SQL}
        SELECT p.p_partkey AS track_id, p.p_name,
               round(CASE WHEN f.track_id IS NOT NULL THEN f.tempo WHEN a.track_id IS NOT NULL THEN a.tempo END, 6) AS bpm,
               CASE WHEN f.track_id IS NOT NULL THEN (CASE f.mode WHEN 1 THEN 'Major' WHEN 0 THEN 'Minor' END)
                    WHEN a.track_id IS NOT NULL THEN (CASE a.mode WHEN 1 THEN 'Major' WHEN 0 THEN 'Minor' END) END AS mode,
               round(CASE WHEN f.track_id IS NOT NULL THEN f.valence END, 6) AS valence,
               CASE WHEN f.track_id IS NOT NULL THEN 'features' WHEN a.track_id IS NOT NULL THEN 'analysis' END AS features_source
        FROM part p LEFT JOIN features f ON f.track_id = p.p_partkey LEFT JOIN analysis a ON a.track_id = p.p_partkey""",
    "failed_ids": f"""WITH {_PROVIDERS_SQL}
        SELECT p_partkey AS track_id FROM part
        WHERE p_partkey NOT IN (SELECT track_id FROM features) AND p_partkey NOT IN (SELECT track_id FROM analysis)""",
    "known_ids": f"""WITH {_PROVIDERS_SQL}
        SELECT i.track_id, round(f.tempo, 6) AS tempo,
               CASE f.mode WHEN 1 THEN 'Major' WHEN 0 THEN 'Minor' END AS mode,
               round(f.valence, 6) AS valence, f.track_id IS NOT NULL AS found
        FROM (VALUES {', '.join(f'({i})' for i in KNOWN_IDS)}) i(track_id)
        LEFT JOIN features f ON f.track_id = i.track_id""",
    "cache_upsert": f"""WITH old AS (
          SELECT song_key, bpm, mode FROM (
            SELECT lower(p_name || '|||' || p_brand) AS song_key, CAST(40 + 2 * p_size AS DOUBLE) AS bpm,
                   {_mode_case()} AS mode, row_number() OVER (PARTITION BY lower(p_name || '|||' || p_brand) ORDER BY p_partkey DESC) AS rn
            FROM part WHERE p_type IN ('ECONOMY', 'MEDIUM', 'SMALL')) WHERE rn = 1
        ), new AS (
          SELECT song_key, bpm, mode FROM (
            SELECT lower(p_name || '|||' || p_brand) AS song_key,
                   CASE WHEN p_size <= 45 THEN CAST(50 + p_size AS DOUBLE) END AS bpm,
                   CASE WHEN p_type = 'LARGE' THEN 'Minor' ELSE 'Major' END AS mode,
                   row_number() OVER (PARTITION BY lower(p_name || '|||' || p_brand) ORDER BY p_partkey DESC) AS rn
            FROM part WHERE p_type IN ('MEDIUM', 'LARGE', 'PROMO', 'STANDARD')) WHERE rn = 1
        )
        SELECT song_key, round(bpm, 6) AS bpm, mode, 'old' AS origin FROM old WHERE song_key NOT IN (SELECT song_key FROM new)
        UNION ALL
        SELECT song_key, round(bpm, 6) AS bpm, mode, 'new' AS origin FROM new""",
}

QUERIES = {
    "merge_back": q_merge_back,
    "catalog_hits": q_catalog_hits,
    "not_found": q_not_found,
    "search_hits": q_search_hits,
    "search_not_found": q_search_not_found,
    "features_fallback": q_features_fallback,
    "failed_ids": q_failed_ids,
    "known_ids": q_known_ids,
    "cache_upsert": q_cache_upsert,
}
