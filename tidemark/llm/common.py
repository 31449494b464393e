"""Small helpers the corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, new_shared_path

HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here, and a lost executor costs nothing."""
    return stored_at(df, label)[0]


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the table's folder, for a table to be removed once others hold what it was read for."""
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under fixed names; a null text becomes empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def held_out(id_col: Column) -> Column:
    """True for the fifth of all ids that no model may learn from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(HELD_OUT_FOLDS)) == 0, F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(rows: Iterable[pa.RecordBatch], size: int = 512, max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a few rows, or few bytes, are Python objects at a time."""
    for batch in rows:
        n = batch.num_rows
        step = max(1, min(size, math.floor(n * max_bytes / max(batch.nbytes, 1))))
        for start in range(0, n, step):
            yield batch.slice(start, step)
