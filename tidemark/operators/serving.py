"""Serving queries over the gold tables and the physical layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions.numbers import cents, exact_sum


def stage_metrics(
    fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, quarantine_summary: DataFrame
) -> DataFrame:
    """One row of pipeline totals.

    Each table is reduced to one row on its own; the four rows are stacked and folded, so no
    table is read twice and nothing is joined.
    """
    parts = [
        fact.agg(
            F.count("*").alias("gold_fact_rows"),
            exact_sum(F.col("gross_amount")).alias("gross_revenue"),
            F.count_if("is_late_arrival").alias("late_arrivals"),
        ),
        dim_customer.agg(
            F.count_distinct("customer_key").alias("gold_customers"),
            F.sum("total_events").alias("total_valid_events"),
        ),
        dim_product.agg(F.count_distinct("product_key").alias("gold_products")),
        quarantine_summary.agg(F.sum("reject_count").alias("quarantined_rows")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    whole = ("gold_fact_rows", "gold_customers", "gold_products", "quarantined_rows", "late_arrivals", "total_valid_events")
    folded = stacked.agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in whole],
        F.coalesce(F.max("gross_revenue"), F.lit(0.0)).alias("gross_revenue"),
    )
    generated = F.col("total_valid_events") + F.col("quarantined_rows")
    return folded.withColumns(
        {
            "total_generated_events": generated,
            "quarantine_rate_pct": F.when(generated > 0, 100 * F.col("quarantined_rows") / generated).otherwise(0.0),
        }
    )


def daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Order lines, revenue and average order value per calendar day, days with orders only.

    The fact is reduced to one row per day before it meets the dimension, so the join is
    day-sized on both sides and AQE is free to broadcast it by its measured size.
    """
    per_day = fact.groupBy("date_key").agg(
        F.count("*").alias("order_lines"),
        exact_sum(F.col("gross_amount")).alias("revenue"),
        F.count("gross_amount").alias("priced_lines"),
    )
    # A day without a priced line has no average.
    average = cents(F.col("revenue") / F.nullif("priced_lines", F.lit(0)))
    per_day = per_day.withColumn("avg_order_value", average)
    calendar = dim_date.select("date_key", F.col("full_date").alias("day"), "day_name", "is_weekend")
    return (
        per_day.join(calendar, "date_key")
        .select("day", "day_name", "is_weekend", "order_lines", "revenue", "avg_order_value")
        .orderBy("day")
    )


def revenue_totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.coalesce(exact_sum(F.col("revenue")), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.sum("order_lines"), F.lit(0)).alias("order_lines"),
        F.count("*").alias("days"),
    )


def reason_label(reason: Column) -> Column:
    pairs = [F.lit(text) for pair in contract.REASON_LABELS.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), reason), reason)


def quarantine_by_reason(quarantine_summary: DataFrame) -> DataFrame:
    """Rejects per reason with label and share of all rejects, largest first."""
    per_reason = quarantine_summary.groupBy("reject_reason").agg(
        F.sum("reject_count").alias("n"), F.max("last_seen_at").alias("last_seen_at")
    )
    # One row per reason is left here, so a window over all of them is small.
    total = F.sum("n").over(Window.partitionBy())
    return per_reason.select(
        "reject_reason",
        reason_label(F.col("reject_reason")).alias("label"),
        "n",
        "last_seen_at",
        F.when(total > 0, 100 * F.col("n") / total).otherwise(0.0).alias("share_pct"),
    ).orderBy(F.desc("n"), "reject_reason")


def health(lag_seconds: Column) -> Column:
    return (
        F.when(lag_seconds > contract.STALE_AFTER_SECONDS, "stale")
        .when(lag_seconds > contract.LAGGING_AFTER_SECONDS, "lagging")
        .otherwise("fresh")
    )


def freshness(fact: DataFrame, as_of: Column) -> DataFrame:
    """Newest and oldest event, whole seconds behind ``as_of``, days covered, health class."""
    span = fact.agg(
        F.max("event_timestamp").alias("max_event_ts"),
        F.min("event_timestamp").alias("min_event_ts"),
        F.count_distinct("event_date").alias("distinct_days"),
    )
    lag = F.coalesce(F.timestamp_diff("SECOND", F.col("max_event_ts"), as_of), F.lit(0))
    return span.withColumn("lag_seconds", lag).withColumn("health", health(F.col("lag_seconds")))


def late_arrivals(events: DataFrame) -> DataFrame:
    """Late events per day they happened on: kept, flagged, and filed under their own date."""
    return events.groupBy("event_date").agg(
        F.count("*").alias("events"), F.count_if("is_late_arrival").alias("late_events")
    )


def narrow_projection(events: DataFrame) -> DataFrame:
    return events.agg(exact_sum(F.col("gross_amount")).alias("total_revenue"))


def date_filtered(events: DataFrame, event_date: str) -> DataFrame:
    """One day by event type; on a partitioned layout only that day is read."""
    return (
        events.where(F.col("event_date") == event_date)
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), exact_sum(F.col("gross_amount")).alias("revenue"))
    )


def full_groupby(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(F.count("*").alias("n"), F.avg("unit_price").alias("avg_price"))
        .orderBy(F.desc("n"), "event_type")
    )


def pivot_date(events: DataFrame) -> DataFrame:
    """The day with most events; the earliest of equals."""
    return (
        events.groupBy("event_date").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "event_date").limit(1)
    )
