"""Ordered validation of raw events as native column expressions.

Input: one row per payload with ``value STRING`` and ``arrived_at TIMESTAMP``. The first rule
that fails names the reject reason; a row without a reason is valid. Nothing is dropped:
every input row gets exactly one verdict.

The work is laid out as a stack of narrow projections (parse, extract, clock, amounts,
verdict), so that Catalyst evaluates each costly step once per row.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract, schemas
from tidemark.functions import isotime, numbers, payload
from tidemark.functions.binding import out_of_line

PAYLOAD_FIELDS = tuple(c for c in schemas.BRONZE.names if c not in ("event_date", "_validated_at", "_is_late_arrival"))
_SECOND = 1_000_000


def _blank(name: str) -> Column:
    """Absent, JSON null, or the empty string; 0 and false count as present."""
    return F.coalesce(F.col(name) == "", F.lit(True))


def _names_of_blanks(names) -> Column:
    return F.concat_ws(",", *[F.when(_blank(n), F.lit(n)) for n in names])


def _lag_us() -> Column:
    return F.unix_micros("arrived_at") - F.unix_micros("_time.at")


def _extract(raw: DataFrame, *extra: str) -> DataFrame:
    """Parse once and read the fields as text."""
    text, read = F.col("value"), F.col("_read")
    parsed = raw.select("value", "arrived_at", *extra, payload.read_fields(text, PAYLOAD_FIELDS).alias("_read"))
    return parsed.select(
        "value",
        "arrived_at",
        *extra,
        payload.is_sealed(read, text).alias("_sealed"),
        *[F.get(read, F.lit(0))[name].alias(name) for name in PAYLOAD_FIELDS],
    )


@cache
def _readings(application: str) -> dict[str, Column]:
    """Clock and order amounts, NULL where they cannot be read, and the missing fields.

    JSON types are looked up for unusual text only: nothing but a string starts like a
    calendar timestamp, and plain number text means the same with and without quotes.

    Columns are unresolved, so they serve any DataFrame; building this many takes longer than
    planning them, hence once per application.
    """
    text = F.col("value")
    is_order = F.col("event_type") == "order_placed"
    by_type = [
        F.when(F.col("event_type") == kind, _names_of_blanks(names))
        for kind, names in contract.FIELDS_BY_TYPE.items()
    ]
    return {
        "_parsed": F.col("_sealed") | out_of_line(payload.is_single_value(text)),
        "_time": isotime.parse_iso(F.col("event_timestamp")),
        "_time_shape": F.when(F.col("event_timestamp").rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), "STRING").otherwise(
            out_of_line(payload.field_shape(text, "event_timestamp"))
        ),
        "_whole": F.when(
            is_order, numbers.whole_text(F.col("quantity"), payload.field_shape(text, "quantity"))
        ),
        "_price": F.when(
            is_order, numbers.finite_double(F.col("unit_price"), payload.field_shape(text, "unit_price"))
        ),
        "_gaps": _names_of_blanks(contract.REQUIRED_FIELDS),
        "_type_gaps": F.coalesce(*by_type),
    }


def _failed_rules() -> list[tuple[str, Column]]:
    """(reason, failure condition) in checking order; later conditions may assume earlier ones."""
    is_order = F.col("event_type") == "order_placed"
    return [
        ("invalid_json", ~F.col("_parsed")),
        ("not_an_object", payload.top_level_kind(F.col("value")) != "dict"),
        ("missing_required_field", F.col("_gaps") != ""),
        ("unknown_event_type", ~F.col("event_type").isin(*contract.EVENT_TYPES)),
        ("missing_type_specific_field", F.col("_type_gaps") != ""),
        ("malformed_event_id", ~F.col("event_id").rlike(contract.EVENT_ID_SHAPE)),
        ("bad_timestamp_type", F.col("_time_shape") != "STRING"),
        ("unparseable_timestamp", F.col("_time.at").isNull()),
        ("future_timestamp", -_lag_us() > contract.MAX_FUTURE_SECONDS * _SECOND),
        ("non_numeric_amount", is_order & (F.col("_whole").isNull() | F.col("_price").isNull())),
        ("non_positive_quantity", is_order & ~numbers.is_positive_whole(F.col("_whole"))),
        ("negative_price", is_order & (F.col("_price") < 0)),
    ]


def _details() -> dict[str, Column]:
    def shown(name: str) -> Column:
        kind = payload.kind_of_shape(payload.field_shape(F.col("value"), name))
        return payload.display_text(kind, F.col(name))

    return {
        "invalid_json": F.lit("payload is not exactly one JSON value"),
        "not_an_object": payload.top_level_kind(F.col("value")),
        "missing_required_field": F.col("_gaps"),
        "unknown_event_type": shown("event_type"),
        "missing_type_specific_field": F.concat("event_type", F.lit(":"), "_type_gaps"),
        "malformed_event_id": shown("event_id"),
        "bad_timestamp_type": F.concat(
            F.lit("expected string, got "), payload.kind_of_shape(F.col("_time_shape"))
        ),
        "unparseable_timestamp": F.col("event_timestamp"),
        "future_timestamp": F.concat(
            isotime.iso_text(isotime.wall_clock(F.col("_time.at"), F.col("_time.offset_us"))),
            isotime.offset_text(F.col("_time.offset_us")),
        ),
        "non_numeric_amount": F.concat(
            F.lit("qty="),
            shown("quantity"),
            F.lit(" price="),
            shown("unit_price"),
        ),
        "non_positive_quantity": F.col("_whole"),
        "negative_price": payload.float_text(F.col("_price")),
    }


def _case(branches) -> Column:
    """CASE WHEN over (condition, value) pairs; NULL when none holds."""
    (condition, value), *rest = branches
    return reduce(lambda case, branch: case.when(*branch), rest, F.when(condition, value))


@cache
def _verdict(application: str) -> Column:
    return _case([(failed, reason) for reason, failed in _failed_rules()])


@cache
def _detail(application: str) -> Column:
    reason = F.col("reject_reason")
    return out_of_line(_case([(reason == name, detail) for name, detail in _details().items()]))


def _application(df: DataFrame) -> str:
    return df.sparkSession.sparkContext.applicationId


def judge(raw: DataFrame, *extra: str) -> DataFrame:
    """Raw payloads with their verdict.

    Adds ``reject_reason`` (NULL when valid), the payload fields as text, and the working
    columns the shaping functions below need. ``extra`` columns come along.
    """
    application = _application(raw)
    events = _extract(raw, *extra).withColumns(_readings(application))
    # The one-element explode is a fence: without it the optimizer pushes every filter on the
    # verdict below the projections and evaluates the whole stack a second time, inlined.
    return events.withColumn("reject_reason", F.explode(F.array(_verdict(application))))


def valid_events(judged: DataFrame) -> DataFrame:
    """Valid rows in bronze shape, with ``ingest_date``; the same rows as the stored lines."""
    return judged.where("reject_reason IS NULL").select(
        *PAYLOAD_FIELDS,
        *_enrichment(),
        F.date_format("arrived_at", "yyyy-MM-dd").alias("ingest_date"),
    )


def _enrichment() -> list[Column]:
    return [
        F.date_format(isotime.wall_clock(F.col("_time.at"), F.col("_time.offset_us")), "yyyy-MM-dd").alias("event_date"),
        isotime.utc_text(F.col("arrived_at")).alias("_validated_at"),
        (_lag_us() > contract.LATE_AFTER_SECONDS * _SECOND).alias("_is_late_arrival"),
    ]


def bronze_lines(judged: DataFrame) -> DataFrame:
    """Valid rows as NDJSON text: the payload as received plus the three derived fields.

    Fields outside the bronze schema survive. Should a producer already send a field of the
    same name, ours comes last and JSON readers keep the last one.
    """
    return judged.where("reject_reason IS NULL").select(
        _bronze_line().alias("value"), F.date_format("arrived_at", "yyyy-MM-dd").alias("ingest_date")
    )


def _bronze_line() -> Column:
    body = F.rtrim(F.translate("value", "\r\n", "  "), F.lit(payload.JSON_SPACE))
    opened = F.ltrim(F.left(body, F.length(body) - 1), F.lit(payload.BYTE_ORDER_MARK))
    event_date, validated_at, is_late = _enrichment()
    return F.concat(
        opened,
        F.lit(',"event_date":"'),
        event_date,
        F.lit('","_validated_at":"'),
        validated_at,
        F.lit('","_is_late_arrival":'),
        is_late.cast("string"),
        F.lit("}"),
    )


def rejects(judged: DataFrame) -> DataFrame:
    """Rejected rows as quarantine records, with ``ingest_date``.

    Payloads are kept whole, so each can be replayed; one that is not UTF-8 also as its bytes.
    """
    return judged.where("reject_reason IS NOT NULL").select(
        "reject_reason",
        _detail(_application(judged)).alias("reject_detail"),
        isotime.utc_text(F.col("arrived_at")).alias("rejected_at"),
        F.make_valid_utf8("value").alias("raw_payload"),
        F.when(~F.is_valid_utf8("value"), F.base64(F.col("value").cast("binary"))).alias("raw_base64"),
        F.date_format("arrived_at", "yyyy-MM-dd").alias("ingest_date"),
    )


def verdict_rows(judged: DataFrame, *extra: str) -> DataFrame:
    """Everything both sinks store, in one pass: a quarantine record or a bronze line for each payload."""
    rejected = F.col("reject_reason").isNotNull()
    return judged.select(
        "reject_reason",
        F.when(rejected, _detail(_application(judged))).alias("reject_detail"),
        F.when(rejected, isotime.utc_text(F.col("arrived_at"))).alias("rejected_at"),
        F.when(rejected, F.make_valid_utf8("value")).alias("raw_payload"),
        F.when(rejected & ~F.is_valid_utf8("value"), F.base64(F.col("value").cast("binary"))).alias("raw_base64"),
        F.when(~rejected, _bronze_line()).alias("line"),
        F.date_format("arrived_at", "yyyy-MM-dd").alias("ingest_date"),
        *extra,
    )


def reject_counts(judged: DataFrame) -> DataFrame:
    return judged.where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count("*").alias("n"))


def ingest_counters(judged: DataFrame) -> DataFrame:
    """One row: received, valid, quarantined, and one count per reason."""
    return judged.agg(*counter_columns())


def counter_columns() -> list[Column]:
    """The counters as aggregates, for a query of its own or to observe a write."""
    rejected = F.col("reject_reason").isNotNull()
    return [
        F.count("*").alias("received"),
        F.count_if(~rejected).alias("valid"),
        F.count_if(rejected).alias("quarantined"),
        *[F.count_if(F.col("reject_reason") == r).alias(r) for r in contract.REJECT_REASONS],
    ]
