"""Bronze to silver: types, true event date, order amount, one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import isotime
from tidemark.functions.numbers import accepted_double, accepted_int

SILVER_COLUMNS = schemas.SILVER.names
STORED_COLUMNS = schemas.STORED_SILVER.names

# The business order decides; the remaining columns only make ties reproducible.
_TIE_BREAKERS = (
    "event_type",
    "customer_id",
    "product_id",
    "order_id",
    "cart_id",
    "quantity",
    "unit_price",
    "failure_code",
    "is_late_arrival",
)


def typed(bronze: DataFrame, *extra: str) -> DataFrame:
    """Declared types for every column; what does not cast becomes NULL. ``extra`` columns come along.

    Instants and amounts are read as validation reads them, so a valid event keeps its values.
    """
    return bronze.select(
        "event_id",
        "event_type",
        instant(),
        "customer_id",
        "product_id",
        "order_id",
        "cart_id",
        accepted_int(F.col("quantity")).alias("quantity"),
        accepted_double(F.col("unit_price")).alias("unit_price"),
        "failure_code",
        F.try_to_timestamp("_validated_at").alias("validated_at"),
        F.ifnull("_is_late_arrival", F.lit(False)).alias("is_late_arrival"),
        *extra,
    )


def amount_lost() -> Column:
    """An order's quantity or price that validation accepts and no column of silver can hold."""
    quantity = F.col("quantity").isNotNull() & accepted_int(F.col("quantity")).isNull()
    price = F.col("unit_price").isNotNull() & accepted_double(F.col("unit_price")).isNull()
    return F.coalesce((F.col("event_type") == "order_placed") & (quantity | price), F.lit(False))


def instant() -> Column:
    text = F.col("event_timestamp")
    # Valid events have ISO-8601 text; what else is stored gets the general cast.
    return F.coalesce(isotime.parse_iso(text)["at"], F.try_to_timestamp(text)).alias("event_timestamp")


def gross_amount() -> Column:
    """Order value in cents precision; NULL for every other event type."""
    value = F.round(F.col("quantity") * F.col("unit_price"), 2)
    return F.when(F.col("event_type") == "order_placed", value)


def dated(events: DataFrame) -> DataFrame:
    """Rows with a usable timestamp, with their own ``event_date``.

    Late events keep the day they happened on. No watermark here: it would drop them.
    """
    return events.where("event_timestamp IS NOT NULL").withColumns(
        {"event_date": F.date_format("event_timestamp", "yyyy-MM-dd"), "gross_amount": gross_amount()}
    )


def latest_copy(events: DataFrame, *last: Column) -> DataFrame:
    """The most recently validated copy of each ``event_id``; ``last`` decides among equal copies.

    Spark trims each map task to one row per key before the shuffle (WindowGroupLimit), so a
    hot key costs one row per task, not one oversized group.
    """
    newest_first = Window.partitionBy("event_id").orderBy(
        F.desc_nulls_last("validated_at"),
        F.desc_nulls_last("event_timestamp"),
        *[F.desc_nulls_last(c) for c in _TIE_BREAKERS],
        *last,
    )
    ranked = events.withColumn("copy_rank", F.row_number().over(newest_first))
    return ranked.where("copy_rank = 1").drop("copy_rank")


def silver(bronze: DataFrame) -> DataFrame:
    return latest_copy(dated(typed(bronze))).select(*SILVER_COLUMNS)


def silver_counters(bronze: DataFrame) -> DataFrame:
    """One row that reconciles: rows_in = unparseable + duplicates + rows_out.

    One scan and one narrow shuffle; copies are counted before they move.
    """
    per_event = (
        bronze.select("event_id", instant())
        .groupBy("event_id")
        .agg(F.count("*").alias("copies"), F.count("event_timestamp").alias("usable"))
    )
    totals = per_event.agg(
        F.sum("copies").alias("rows_in"),
        F.sum(F.col("copies") - F.col("usable")).alias("unparseable"),
        F.count_if(F.col("usable") > 0).alias("rows_out"),
    )
    filled = totals.na.fill(0)
    return filled.withColumn("duplicates", F.expr("rows_in - unparseable - rows_out"))
