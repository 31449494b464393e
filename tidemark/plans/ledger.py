"""One-row Parquet marks: what a finished step leaves, so that a repeat knows where it stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sinks import folders


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows that a finished step left at the path, which may have wildcards, if it did."""
    if not folders.found(spark, path):
        return None
    rows = spark.read.schema(schema).parquet(path)
    return None if rows.isEmpty() else rows


def store(spark: SparkSession, path: str, schema: T.StructType, rows: list[tuple]) -> None:
    """A few rows in one file; a mark counts once it has them."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
