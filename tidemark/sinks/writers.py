"""Writers. Output sizes follow the data through AQE instead of a fixed file count."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.tables import JSON_TIMESTAMP


# gzip cannot be split by readers, so no file may grow large.
_GZIP_RECORDS = 500_000


def _gzip(df: DataFrame):
    return df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", _GZIP_RECORDS)


def write_quarantine(rejects: DataFrame, path: str) -> None:
    """gzip NDJSON of one batch, as it comes: a single folder whatever reasons and days it has.

    Writing the batch again replaces the folder.
    """
    _gzip(rejects.drop("ingest_date")).json(path)


def write_bronze(lines: DataFrame, path: str) -> None:
    """gzip NDJSON of one batch, as it comes; ``value`` holds ready JSON text. Writing it again replaces it."""
    _gzip(lines.select("value")).text(path)


def write_quarantine_batches(rejects: DataFrame, path: str) -> None:
    """``write_quarantine`` of several batches, named by the column ``batch``, below their common folder."""
    _replace_own_partitions(rejects.drop("ingest_date")).partitionBy("batch").json(path)


def write_bronze_batches(lines: DataFrame, path: str) -> None:
    """``write_bronze`` of several batches, named by the column ``batch``, below their common folder."""
    _replace_own_partitions(lines.select("value", "batch")).partitionBy("batch").text(path)


def _replace_own_partitions(df: DataFrame):
    """Overwrite the partitions present in ``df`` and leave all others alone."""
    return _gzip(df).option("partitionOverwriteMode", "dynamic")


def write_quarantine_segment(rejects: DataFrame, path: str) -> None:
    """gzip NDJSON by reason, ingest day and segment; writing a segment again replaces it."""
    gathered = rejects.hint("rebalance", "reject_reason", "ingest_date")
    _replace_own_partitions(gathered).partitionBy("reject_reason", "ingest_date", "segment").json(path)


def write_bronze_segment(lines: DataFrame, path: str) -> None:
    """gzip NDJSON by ingest day and segment; ``value`` holds ready JSON text."""
    gathered = lines.hint("rebalance", "ingest_date")
    _replace_own_partitions(gathered).partitionBy("ingest_date", "segment").text(path)


def write_by_date(events: DataFrame, path: str, max_records_per_file: int = 5_000_000, only_own_days: bool = False) -> None:
    """Snappy Parquet by ``event_date``, full overwrite, or of the days in ``events`` alone.

    The rebalance gathers each day so that it ends up in few files; AQE splits a day that
    outgrows one task and joins small ones.
    """
    (
        events.hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_own_days else "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("event_date")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Unpartitioned Snappy Parquet, as it comes: a scan keeps its splits and their order of days,
    and AQE has joined the small partitions of an aggregation already."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_clustered(events: DataFrame, path: str) -> None:
    """Unpartitioned Snappy Parquet in ranges of day, type and id, for readers that skip by statistics.

    A day is a run of pages in few files, a hot day as many files as its ids need. Ids, which the
    ranges scatter over days, have Bloom filters. The price is one shuffle of the rows.
    """
    order = ["event_date", "event_type", "event_id"]
    (
        events.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#event_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def write_raw_json_layout(events: DataFrame, path: str) -> None:
    (
        events.write.mode("overwrite")
        .option("compression", "none")
        .option("timestampFormat", JSON_TIMESTAMP)
        .json(path)
    )
