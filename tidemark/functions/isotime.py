"""ISO-8601 timestamps, in every spelling the event contract accepts.

Nearly all events use ``YYYY-MM-DDTHH:MM:SS[.fraction](Z|+HH:MM)``, which Spark parses
directly. The rarer spellings (compact, week dates, other separators, long offsets) go
through one regular expression that rewrites them to a fixed list of parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let

COMMON_SHAPE = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?"
    r"(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)\z"
)

# Hours, then minutes and seconds if given; digits after a point count as microseconds
# whichever field they follow.
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,](\d{1,6})\d*)?"
_DATE = (
    r"(?!0000)(?:(\d{4})-(\d{2})-(\d{2})"  # calendar date
    r"|(\d{4})(\d{2})(\d{2})"  # compact calendar date
    r"|(\d{4})-W(\d{2})(?:-(\d)(?!\d))?"  # week date
    # Compact week date. A digit may also act as the separator before an even number of
    # clock digits, so the weekday is present only if that leaves the clock whole.
    r"|(\d{4})W(\d{2})(?:(\d)(?=(?:\d(?:\d\d)*)?(?:\D|\z)))?)"
)
_GENERAL = rf"(?s)\A{_DATE}(?:.{_CLOCK}(?:([+-]){_CLOCK})?)?\z"
# Alternatives leave their groups empty, so neighbours can simply be joined.
_PARTS = (
    "$1$4-$2$5-$3$6|$7$10|$8$11|$9$12"
    "|$13:$14$16:$15$17.$18\\000000"
    "|$19|$20:$21$23:$22$24.$25\\000000"
)
# Missing clock fields become 00, fractions are padded to six digits.
_CLOCK_GAPS = r"^(?=:)|(?<=:)(?=[:.])"
_CLOCK_TAIL = r"(\.\d{6})\d*"


def _clock_text(part: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(part, _CLOCK_GAPS, "00"), _CLOCK_TAIL, "$1")


def _week_date(year: Column, week: Column, weekday: Column) -> Column:
    """ISO week date as a date; NULL when the year has no such week."""
    january_4 = F.make_date(year, F.lit(1), F.lit(4))
    day = F.date_add(january_4, (week - 1) * 7 + weekday - 1 - F.weekday(january_4))
    last_week = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    return F.when((week >= 1) & (week <= last_week) & weekday.between(1, 7) & (F.year(day) <= 9999), day)


def _micros(clock: Column) -> Column:
    """``HH:MM:SS.ffffff`` as microseconds, fields unchecked (offsets may say 00:99)."""
    return (
        F.substring(clock, 1, 2).cast("bigint") * 3_600_000_000
        + F.substring(clock, 4, 2).cast("bigint") * 60_000_000
        + F.substring(clock, 7, 2).cast("bigint") * 1_000_000
        + F.substring(clock, 10, 6).cast("bigint")
    )


def _general(raw: Column) -> Column:
    text = F.replace(raw, F.lit("Z"), F.lit("+00:00"))
    parts = F.when(text.rlike(_GENERAL), F.split(F.regexp_replace(text, _GENERAL, _PARTS), r"\|"))
    return let(parts, lambda p: let(_pieces(p), _assemble))


def _pieces(parts: Column) -> Column:
    weekday = F.coalesce(F.nullif(parts[3], F.lit("")), F.lit("1"))
    week_date = _week_date(parts[1].try_cast("int"), parts[2].try_cast("int"), weekday.try_cast("int"))
    zone = _clock_text(parts[6])
    return F.struct(
        F.when(parts[1] != "", week_date.cast("string")).otherwise(parts[0]).alias("day"),
        _clock_text(parts[4]).alias("clock"),
        # An offset below one second is plain UTC.
        F.when(zone.startswith("00:00:00."), F.lit(0).cast("bigint"))
        .otherwise(F.when(parts[5] == "-", F.lit(-1)).otherwise(1) * _micros(zone))
        .alias("offset_us"),
    )


def _assemble(pieces: Column) -> Column:
    wall = F.try_to_timestamp(F.concat(pieces["day"], F.lit(" "), pieces["clock"]))
    usable = wall.isNotNull() & (F.abs(pieces["offset_us"]) < 86_400_000_000)
    at = F.timestamp_micros(F.unix_micros(wall) - pieces["offset_us"])
    return F.when(usable, F.struct(at.alias("at"), pieces["offset_us"].alias("offset_us")))


def _common(text: Column) -> Column:
    minutes = F.substring(text, -5, 2).try_cast("bigint") * 60 + F.substring(text, -2, 2).try_cast("bigint")
    sign = F.when(F.substring(text, -6, 1) == "-", F.lit(-60_000_000)).otherwise(60_000_000)
    return F.struct(
        F.try_to_timestamp(text).alias("at"),
        F.when(text.endswith("Z"), F.lit(0).cast("bigint")).otherwise(sign * minutes).alias("offset_us"),
    )


def parse_iso(raw: Column) -> Column:
    """``struct<at timestamp, offset_us bigint>``; ``at`` is NULL for anything unparseable."""
    return F.when(raw.rlike(COMMON_SHAPE), _common(raw)).otherwise(_general(raw))


def wall_clock(at: Column, offset_us: Column) -> Column:
    """The instant as a clock in its own offset shows it."""
    return F.timestamp_micros(F.unix_micros(at) + offset_us)


def iso_text(at: Column) -> Column:
    """``2026-07-31T10:00:00[.ffffff]``; the fraction only when there is one."""
    return F.concat(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        _fraction(F.pmod(F.unix_micros(at), F.lit(1_000_000))),
    )


def utc_text(at: Column) -> Column:
    return F.concat(iso_text(at), F.lit("+00:00"))


def offset_text(offset_us: Column) -> Column:
    """``+05:30``, with seconds and their fraction only when there are any."""
    clock = F.timestamp_micros(F.abs(offset_us))
    return F.concat(
        F.when(offset_us < 0, "-").otherwise("+"),
        F.date_format(clock, "HH:mm"),
        F.when(F.abs(offset_us) % 60_000_000 > 0, F.date_format(clock, ":ss")).otherwise(""),
        _fraction(F.abs(offset_us) % 1_000_000),
    )


def _fraction(micros: Column) -> Column:
    return F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise("")
