"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_path, ship_package, table_path

BATCH_ROWS = 512          # rows of an Arrow batch handed to Python
BATCH_BYTES = 16 << 20    # and its bytes, where the session knows that setting


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder, package on the executors, small Arrow batches (texts can be long)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(table_path(sf_dir, name))


def text_of(col: str | Column) -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(batch):
    """The columns of an Arrow batch as Python lists, by name."""
    return {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}


def few_texts(docs: DataFrame, rows: int, chars: int) -> DataFrame:
    """(text) of the first ``rows`` rows of at most ``chars`` characters, as literals of a plan:
    ``take`` reads no more files than it needs, and nothing grows with ``docs``."""
    text = docs.select(text_of("text").alias("text")).where(F.char_length("text") <= chars)
    few = [F.lit(r["text"]) for r in text.take(rows)]
    one = docs.sparkSession.range(1)
    return one.select(F.explode(F.array(*few)).alias("text")) if few else one.select(F.lit("").alias("text")).where("false")
