"""Corpus pipeline over the documents table: rules, near duplicates, repeats, benchmarks, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept and returns
a DataFrame, which ``run`` writes to the shared folder and reads again.  All but the last return
the columns of documents; other columns are dropped at the start.  NULL texts count as empty (the
first stage rejects them); an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.base import prepare, stored, table
from cadenza.llm.bpe import encode_decode
from cadenza.llm.decontaminate import contamination
from cadenza.llm.jaccard_join import one_of_each
from cadenza.llm.quality_rules import keep_good
from cadenza.llm.repeated_spans import without_repeats

#: Bytes of a repeated string that suffix_dedup cuts: about 50 words.  (The 400 of the operator's own query
#: are longer than most repeated passages of that many words.)
PASSAGE = 240
PASSAGE_GRAM = 64      # bytes of its anchors; see repeated_spans

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepare(spark)
    return keep_good(docs.select(*COLUMNS))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least doc_id."""
    prepare(spark)
    return one_of_each(docs.select(*COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes inside repeated strings of ``PASSAGE`` bytes; what a cut leaves of a character goes
    with it, and n_chars follows.  A document of which only white space is left goes."""
    prepare(spark)
    kept = without_repeats(docs.select(*COLUMNS), length=PASSAGE, gram=PASSAGE_GRAM, as_bytes=False)
    cut = F.size("removed") > 0
    blank = F.trim(F.translate("kept_text", "\t\n\x0b\f\r", "     ")) == ""
    return kept.where(~(cut & blank)).select(
        "doc_id", F.when(cut, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(cut, F.char_length("kept_text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    found = contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hit_spans") == 0).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids (little-endian unsigned 32-bit), with digests of the ids and of the
    text decoded from them."""
    prepare(spark)
    coded = encode_decode(docs, keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id", "lang", "source", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("bpe", bpe)]

#: Byte-level cuts and BPE are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
