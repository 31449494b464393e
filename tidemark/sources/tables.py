"""Stored tables, read with declared schemas and string partition columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sinks import folders

JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _with_strings(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(n, T.StringType()) for n in names])


def read_segments(spark: SparkSession, path: str, schema: T.StructType, *partitions: str) -> DataFrame:
    """Compacted NDJSON; partition values and the segment come from the path, the records do not repeat them."""
    return spark.read.schema(_with_strings(schema, *partitions, "segment")).option("basePath", path).json(path)


def read_open(spark: SparkSession, path: str, schema: T.StructType, stamp: str) -> DataFrame:
    """Batches that are not compacted yet, with their label; the ingest day is that of the stamp."""
    table = spark.read.schema(_with_strings(schema, "batch")).option("basePath", path).json(path)
    return table.withColumn("ingest_date", F.left(F.col(stamp), F.lit(10)))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.SILVER)


def read_raw_json_layout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).option("timestampFormat", JSON_TIMESTAMP).json(path)


def _or_empty(spark: SparkSession, path: str, read: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """A table that was never written is empty; every read problem surfaces."""
    return read() if folders.exists(spark, path) else spark.createDataFrame([], schema)


def segments_or_empty(spark: SparkSession, path: str, schema: T.StructType, *partitions: str) -> DataFrame:
    columns = _with_strings(schema, *partitions, "segment")
    return _or_empty(spark, path, lambda: read_segments(spark, path, schema, *partitions), columns)


def open_or_empty(spark: SparkSession, path: str, schema: T.StructType, stamp: str) -> DataFrame:
    columns = _with_strings(schema, "batch", "ingest_date")
    return _or_empty(spark, path, lambda: read_open(spark, path, schema, stamp), columns)


# Every stored line ends with the fields that validation adds, so the last stamp is its own.
_STAMP_OF_LINE = r'.*"_validated_at":"(\d{4}-\d{2}-\d{2})'
_LINE_END_CHARS = 100


def open_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, batch, ingest_date): the stored lines of open batches as text."""
    columns = _with_strings(T.StructType([]), "value", "batch")
    lines = _lines_or_empty(spark, path, columns)
    tail = F.right(F.col("value"), F.lit(_LINE_END_CHARS))
    return lines.withColumn("ingest_date", F.regexp_extract(tail, _STAMP_OF_LINE, 1))


def segment_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ingest_date, segment): the stored lines of segments as text."""
    columns = _with_strings(T.StructType([]), "value", "ingest_date", "segment")
    return _lines_or_empty(spark, path, columns)


def _lines_or_empty(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    read = lambda: spark.read.schema(columns).option("basePath", path).option("lineSep", "\n").text(path)
    return _or_empty(spark, path, read, columns)


def silver_or_empty(spark: SparkSession, path: str) -> DataFrame:
    return _or_empty(spark, path, lambda: read_silver(spark, path), schemas.SILVER)
