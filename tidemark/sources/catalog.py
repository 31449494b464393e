"""The nine declared tables, for plain SQL access. No crawling, no inference."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark import schemas
from tidemark.sinks import folders
from tidemark.sources.tables import JSON_TIMESTAMP

# Table name -> (location below the root, format, columns, partition column).
TABLES = {
    "silver_events": ("silver", "parquet", schemas.EVENT_DDL, "event_date"),
    "fact_orders": ("gold/fact_orders", "parquet", schemas.FACT_ORDERS_DDL, "event_date"),
    "dim_customer": ("gold/dim_customer", "parquet", schemas.DIM_CUSTOMER_DDL, None),
    "dim_product": ("gold/dim_product", "parquet", schemas.DIM_PRODUCT_DDL, None),
    "dim_date": ("gold/dim_date", "parquet", schemas.DIM_DATE_DDL, None),
    "quarantine_summary": ("gold/quarantine_summary", "parquet", schemas.QUARANTINE_SUMMARY_DDL, None),
    "bench_raw_json": ("bench/raw_json", "json", schemas.EVENT_DDL, None),
    "bench_parquet_flat": ("bench/parquet_flat", "parquet", schemas.EVENT_DDL, None),
    "bench_parquet_part": ("bench/parquet_part", "parquet", schemas.EVENT_DDL, "event_date"),
}


def declare_tables(spark: SparkSession, root: str, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/catalog'")
    for name, (location, kind, columns, partition) in TABLES.items():
        if _declared_at(spark, f"{database}.{name}") not in (None, _plain_path(f"{root}/{location}")):
            # Declared over another lake: only the declaration goes, tables with a location keep their files.
            spark.sql(f"DROP TABLE {database}.{name}")
        options = f"OPTIONS (timestampFormat \"{JSON_TIMESTAMP}\")" if kind == "json" else ""
        partitioning = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {kind} {options} "
            f"{partitioning} LOCATION '{root}/{location}'"
        )


def _plain_path(location: str) -> str:
    """A path to compare: a local one without its scheme."""
    return location.removeprefix("file://").removeprefix("file:").rstrip("/")


def _declared_at(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return _plain_path(facts["data_type"])


def register_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Add every partition folder found at the location; known ones stay as they are."""
    spark.catalog.recoverPartitions(f"{database}.{table}")


def register_days(spark: SparkSession, database: str, table: str, path: str, days: list[str]) -> None:
    """Add the days that have a folder and drop those that have none; other partitions are not looked at."""
    there = [d for d in days if folders.exists(spark, f"{path}/event_date={d}")]
    spec = lambda d: f"PARTITION (event_date='{d}')"
    if there:
        spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS " + " ".join(spec(d) for d in there))
    gone = sorted(set(days) - set(there))
    if gone:
        spark.sql(f"ALTER TABLE {database}.{table} DROP IF EXISTS " + ", ".join(spec(d) for d in gone))
    spark.catalog.refreshTable(f"{database}.{table}")


def refresh(spark: SparkSession, database: str) -> None:
    for name, (_, _, _, partition) in TABLES.items():
        if partition:
            register_partitions(spark, database, name)
        else:
            spark.catalog.refreshTable(f"{database}.{name}")
