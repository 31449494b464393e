"""Silver to gold: order-line fact, customer, product and date dimensions, reject summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import keys
from tidemark.functions.numbers import cents


def _times(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def dim_customer(silver: DataFrame) -> DataFrame:
    """One row per customer, over events of every type."""
    seen = F.col("event_timestamp")
    per_customer = silver.where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.min(seen).alias("first_seen_at"),
        F.max(seen).alias("last_seen_at"),
        F.count("*").alias("total_events"),
        _times("order_placed").alias("total_orders"),
    )
    return per_customer.select(keys.customer_key().alias("customer_key"), *per_customer.columns)


def dim_product(silver: DataFrame) -> DataFrame:
    """One row per product; the category is the id up to its first dash."""
    per_product = silver.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.avg(F.expr("CASE WHEN unit_price > 0 THEN unit_price END")).alias("mean_price"),
        _times("product_viewed").alias("times_viewed"),
        _times("order_placed").alias("times_ordered"),
    )
    return per_product.select(
        keys.product_key().alias("product_key"),
        "product_id",
        F.substring_index("product_id", "-", 1).alias("category"),
        cents(F.col("mean_price")).alias("avg_unit_price"),
        "times_viewed",
        "times_ordered",
    )


def dim_date(silver: DataFrame) -> DataFrame:
    """Every day from the first to the last event, with or without events."""
    span = silver.agg(
        F.min("event_timestamp").cast("date").alias("first_day"),
        F.max("event_timestamp").cast("date").alias("last_day"),
    )
    days = span.where("first_day IS NOT NULL").select(
        F.explode(F.expr("sequence(first_day, last_day, INTERVAL 1 DAY)")).alias("full_date")
    )
    return days.selectExpr(
        "year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS date_key",
        "full_date",
        "year(full_date) AS year",
        "quarter(full_date) AS quarter",
        "month(full_date) AS month",
        "day(full_date) AS day",
        "dayofweek(full_date) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "dayofweek(full_date) IN (1, 7) AS is_weekend",
    )


def fact_orders(silver: DataFrame) -> DataFrame:
    """One row per order line; other event types are other processes at other grains."""
    return silver.where("event_type = 'order_placed'").select(
        keys.order_key().alias("order_key"),
        "order_id",
        keys.customer_key().alias("customer_key"),
        keys.product_key().alias("product_key"),
        keys.date_key(F.col("event_timestamp")).alias("date_key"),
        "quantity",
        "unit_price",
        "gross_amount",
        "event_timestamp",
        "is_late_arrival",
        "event_date",
    )


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Counts per reason and ingest day. Carries no payload.

    The sample detail is the smallest one, so that repeated runs agree.
    """
    return quarantine.groupBy("reject_reason", "ingest_date").agg(
        F.count("*").alias("reject_count"),
        F.max("rejected_at").alias("last_seen_at"),
        F.left(F.min("reject_detail"), F.lit(contract.SHORT_DETAIL_CHARS)).alias("sample_detail"),
    )


def freshness_lag(fact: DataFrame, as_of: Column) -> DataFrame:
    """Seconds between ``as_of`` and the newest fact, never negative; no row without facts."""
    newest = fact.agg(F.max("event_timestamp").alias("newest")).where("newest IS NOT NULL")
    lag = (F.unix_micros(as_of) - F.unix_micros("newest")) / 1e6
    return newest.select(F.greatest(lag, F.lit(0.0)).alias("lag_seconds"))
