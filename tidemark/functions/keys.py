"""Surrogate keys: stable across runs and load order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the non-NULL parts joined by ``|``."""
    return F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(16))


def customer_key(customer_id: str = "customer_id") -> Column:
    return surrogate_key(F.lit("cust"), F.col(customer_id))


def product_key(product_id: str = "product_id") -> Column:
    return surrogate_key(F.lit("prod"), F.col(product_id))


def order_key() -> Column:
    return surrogate_key(F.col("order_id"), F.col("product_id"))


def date_key(date_or_timestamp: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than formatting and parsing."""
    return (
        F.year(date_or_timestamp) * 10000 + F.month(date_or_timestamp) * 100 + F.dayofmonth(date_or_timestamp)
    ).cast("int")
