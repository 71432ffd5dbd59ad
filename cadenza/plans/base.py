"""Shared helpers of the driver-table plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import table_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT output column (comparison-stable output)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def dbl(x: float) -> str:
    """A double literal for oracle SQL, identical to the Python float."""
    return f"CAST({x!r} AS DOUBLE)"
