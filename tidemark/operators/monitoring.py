"""Data-quality alarms: share of rejected events, and freshness of what arrives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract

_RATE_PERIOD = f"{contract.RATE_PERIOD_SECONDS} seconds"


def reject_rate(received: Column, rejected: Column) -> Column:
    return F.when(received > 0, 100 * rejected / received).otherwise(0.0)


def reject_rate_windows(judged: DataFrame) -> DataFrame:
    """Received and rejected per tumbling period of arrival. Works on batch and streams."""
    per_period = judged.groupBy(F.window("arrived_at", _RATE_PERIOD)).agg(
        F.count("*").alias("received"), F.count("reject_reason").alias("rejected")
    )
    return per_period.select(
        F.col("window.start").alias("period_start"),
        "received",
        "rejected",
        reject_rate(F.col("received"), F.col("rejected")).alias("reject_rate_pct"),
    )


def reject_rate_alarm(windows: DataFrame) -> DataFrame:
    """Adds ``breaching`` and ``in_alarm`` (every one of the last periods breached).

    A period without data does not breach. Each period reports its breach to itself and to
    the periods it still counts for, and a second aggregation adds the reports up: no
    ordering over all periods and no self-join.
    """
    needed = contract.RATE_PERIODS_TO_ALARM
    breaching = F.col("reject_rate_pct") > contract.RATE_THRESHOLD_PCT
    reports = windows.withColumn("breaching", breaching).withColumn(
        "ahead", F.explode(F.sequence(F.lit(0), F.lit(needed - 1)))
    )
    later = F.timestamp_micros(
        F.unix_micros("period_start") + F.col("ahead") * contract.RATE_PERIOD_SECONDS * 1_000_000
    )
    own = F.when(
        F.col("ahead") == 0, F.struct("received", "rejected", "reject_rate_pct", "breaching")
    )
    per_period = reports.groupBy(later.alias("period_start")).agg(
        F.max(own).alias("own"), F.count_if("breaching").alias("breaches")
    )
    return per_period.where("own IS NOT NULL").select(
        "period_start", "own.*", (F.col("breaches") == needed).alias("in_alarm")
    )


def freshness_points(typed_events: DataFrame) -> DataFrame:
    """One observation per hour of arrival: how far the newest order so far trails the latest arrival.

    Events are reduced to a row per hour before the running maximum, so the window that orders
    all of time sees hours, not events.
    """
    orders = typed_events.where("event_type = 'order_placed' AND event_timestamp IS NOT NULL")
    per_hour = orders.groupBy(F.date_trunc("hour", "validated_at").alias("hour")).agg(
        F.max("validated_at").alias("observed_at"), F.max("event_timestamp").alias("newest_of_hour")
    )
    so_far = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_hour.where("hour IS NOT NULL").withColumn("newest", F.max("newest_of_hour").over(so_far))
    lag = (F.unix_micros("observed_at") - F.unix_micros("newest")) / 1e6
    return running.select("observed_at", F.greatest(lag, F.lit(0.0)).alias("lag_seconds"))


def freshness_alarm(points: DataFrame) -> DataFrame:
    """Every hour from the first to the last observation; an hour without one is breaching.

    Each observed hour fills the gap up to the next one: no spine, no join.
    """
    period = contract.FRESHNESS_PERIOD_SECONDS * 1_000_000
    hours = F.unix_micros("observed_at") - F.pmod(F.unix_micros("observed_at"), F.lit(period))
    observed = points.groupBy(hours.alias("start")).agg(F.max("lag_seconds").alias("max_lag_seconds"))
    upto = F.coalesce(F.lead("start").over(Window.orderBy("start")), F.col("start") + period)
    filled = observed.withColumn("upto", upto).select(
        "start", "max_lag_seconds", F.explode(F.sequence(F.col("start"), F.col("upto") - period, F.lit(period))).alias("at")
    )
    lag = F.when(F.col("at") == F.col("start"), F.col("max_lag_seconds"))
    late = lag > contract.FRESHNESS_THRESHOLD_SECONDS
    return filled.select(
        F.timestamp_micros("at").alias("period_start"),
        lag.alias("max_lag_seconds"),
        F.coalesce(late, F.lit(True)).alias("breaching"),
    )
