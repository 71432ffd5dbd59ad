"""Fixtures of the tests in this folder."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("id", "h", "u", "v", "r", "block", "gram", "spans", "kept", "score", "ids", "word", "n", "size",
            "hit_spans", "n_words", "line", "family", "_h", "_k", "_u")


@pytest.fixture(scope="module")
def texts(spark):
    """The texts of the smallest documents table, by doc_id."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


@pytest.fixture
def docs(spark):
    """Makes documents from (doc_id, text) rows, with columns that operators use as names."""
    from pyspark.sql import functions as F

    from cadenza.llm.base import prepare
    prepare(spark)

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS)
        for name in CLASHING if extra else ():
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
