"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import table
from .quality_rules import _UNSPACED


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts
    return (token_counts(table(spark, sf_dir, "documents"))
            .withColumn("over_limit", F.col("n_tokens") > 512))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_report
    return quality_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode
    return encode_decode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeated_spans import without_repeats
    kept = without_repeats(table(spark, sf_dir, "documents"), columns=["doc_id"])
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_id", "n_links")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import main_texts
    return main_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import roundtrip
    return roundtrip(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    start = F.lit(0).cast("bigint")
    return found.select(
        "doc_id", "n_words",
        F.aggregate("hit_spans", start, lambda n, x: n + x["b"] - x["a"]).alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"))


def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxic_spans import toxic_spans, train
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    chain = train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxic_spans(docs, chain).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_report, train
    docs = table(spark, sf_dir, "documents")
    return license_report(docs, train(docs)).select(
        "doc_id", F.array_join("families", ",").alias("families"), "n_confirmed", "n_unknown")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import alignment
    return alignment(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_warc, op3_jaccard_join, op4_token_counts, op5_html_text, op6_quality_rules,
    op7_decontaminate, op8_toxic_spans, op9_bpe, op10_license_scan, op11_packing, op12_prefix_trie, op13_alignment)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
wins AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
         FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM wins) WHERE k > 1),
cov AS (SELECT rid, sum(least(8, i - coalesce(p, i - 8))) AS n
        FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n, count(DISTINCT l) AS u
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
st AS (SELECT rid, len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS n FROM d),
f AS (SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(ln.n - ln.u, 0) AS BIGINT) AS n_dup_lines, coalesce(ln.n, 0) AS n_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, st.n AS n_stutters,
        length(text) - length(regexp_replace(text, '{_UNSPACED}', '', 'g')) AS n_unspaced
      FROM d LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN st USING (rid)),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 6 * n_lines OR 4 * n_stutters > n_words
       OR (word_chars > 12 * n_words AND 2 * n_unspaced <= word_chars) OR word_chars < 2 * n_words) AS kept
FROM b
"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_HEX = "'0123456789abcdef'"
OP2_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id, count(*) OVER (PARTITION BY h) AS k FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr({_B32}, CAST(1 +
    ((((strpos({_HEX}, h[(5 * i) // 4 + 1]) - 1) * 16 + greatest(strpos({_HEX}, h[(5 * i) // 4 + 2]) - 1, 0))
      >> (3 - (5 * i) % 4)) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN k = 1 OR first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM q
"""

OP7_SQL = r"""
WITH norm AS (SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pats AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + 9], ' ') AS g
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM pats),
wins AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
         FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM norm, sizes WHERE len(w) >= k)),
hits AS (SELECT rid, wins.k, i, item FROM wins JOIN pats ON wins.k = pats.k AND wins.g = pats.g),
cov AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, CAST(strlen(s) AS BIGINT) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, h, len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(h, 1, 32)) - 1 AS place FROM t),
convs AS (SELECT conv_id, {_CRC32} % 4 AS n FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
turns AS (SELECT convs.conv_id, place, 0 AS k, h, words FROM convs JOIN own ON own.conv_id = convs.conv_id - convs.conv_id % 20 AND place < n
          UNION ALL SELECT conv_id, place, 1, h, words FROM own JOIN convs USING (conv_id) WHERE place >= n),
pre AS (SELECT conv_id, row_number() OVER w AS depth, words, string_agg(h, '') OVER w AS node FROM turns
        WINDOW w AS (PARTITION BY conv_id ORDER BY k, place ROWS UNBOUNDED PRECEDING)),
paths AS (SELECT conv_id, depth, words, sha256(node) AS node,
            CASE WHEN depth = 1 THEN '' ELSE sha256(substr(node, 1, 64 * (depth - 1))) END AS parent FROM pre
          UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
lens AS (SELECT conv_id, max(depth) AS l FROM paths GROUP BY conv_id),
nodes AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, count(*) AS n_convs,
            min(conv_id) AS conv_id, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = l), '') AS ends
          FROM paths JOIN lens USING (conv_id) GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
tree AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
sums AS (SELECT paths.node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * tree.words) AS saved_tokens
         FROM tree JOIN paths ON paths.conv_id = tree.conv_id AND paths.depth <= tree.depth GROUP BY paths.node)
SELECT tree.conv_id, tree.depth, up.conv_id AS parent_conv_id, tree.n_convs, tree.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(tree.ends) AS ends_sha256
FROM tree JOIN sums USING (node) LEFT JOIN nodes up ON up.node = tree.parent
"""

ORACLE = {"op2_warc": OP2_SQL, "op6_quality_rules": OP6_SQL, "op7_decontaminate": OP7_SQL, "op12_prefix_trie": OP12_SQL}
