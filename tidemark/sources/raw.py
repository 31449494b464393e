"""Raw payloads: one opaque line each, in batch or as a stream.

Lines may be stamped by whoever collected them: the arrival in microseconds since 1970, a tab, the
payload. A stamp alone is a heartbeat: nothing arrived, but the time has come. What does not begin with
a stamp is a payload as it is, and arrives now.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


# A carriage return is part of a payload (JSON space), only a line feed ends one.
_LINE_END = "\n"
_TAB = "\t"


def read_raw(spark: SparkSession, path: str, now: Column | None = None, stamped: bool = False, heartbeats: bool = False) -> DataFrame:
    """Text files as ``value, arrived_at``; ``now`` defaults to the start of the query.

    Each line is a payload. A blank line is one too, and is rejected as ``invalid_json``.
    """
    lines = spark.read.schema(schemas.RAW).option("lineSep", _LINE_END).text(path)
    return _arrived(lines, now, stamped, heartbeats)


def stream_raw(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 1000,
    now: Column | None = None,
    max_bytes_per_trigger: int | None = None,
    stamped: bool = False,
    heartbeats: bool = False,
    files: bool = False,
) -> DataFrame:
    """The same as a stream. A batch takes so many files, or files of so many bytes, one at least.

    With ``files``, ``_file`` and ``_file_bytes`` tell where a line comes from.

    ``current_timestamp()`` is the time the micro-batch was planned. It is stored with the
    batch's offsets, so a replayed batch sees the same time and lands in the same place.
    """
    reader = spark.readStream.schema(schemas.RAW).option("lineSep", _LINE_END)
    if max_bytes_per_trigger is None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    lines = reader.text(path)
    if not files:
        return _arrived(lines, now, stamped, heartbeats)
    at, size = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_file_bytes")
    return _arrived(lines.select("value", at, size), now, stamped, heartbeats, "_file", "_file_bytes")


def _arrived(lines: DataFrame, now: Column | None, stamped: bool, heartbeats: bool, *extra: str) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    if not stamped:
        return lines.withColumn("arrived_at", now)
    head = F.substring_index("value", _TAB, 1)
    micros = head.try_cast("bigint")
    alone = head == F.col("value")
    payload = F.when(micros.isNull(), F.col("value")).when(~alone, F.expr("substring(value, instr(value, '\t') + 1)"))
    rows = lines.select(payload.alias("value"), F.coalesce(F.timestamp_micros(micros), now).alias("arrived_at"), *extra)
    return rows if heartbeats else rows.where("value IS NOT NULL")


def stamped_lines(raw: DataFrame) -> DataFrame:
    """``value, arrived_at`` as stamped lines; a null payload as a heartbeat."""
    return raw.select(stamped_line().alias("value"))


def stamped_line() -> Column:
    return F.concat_ws(_TAB, F.unix_micros("arrived_at").cast("string"), "value")
