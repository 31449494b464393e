"""Numbers in untrusted text, and money rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.payload import kind_of_shape

# Digit groups may be joined by single underscores, and blanks around a number are fine.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_BLANK = r"[\s\x85\p{Z}]*"
INTEGER_TEXT = rf"^{_BLANK}[+-]?{_DIGITS}{_BLANK}\z"
FLOAT_TEXT = (
    rf"^{_BLANK}[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?{_BLANK}\z"
)


def whole_text(text: Column, shape: Column) -> Column:
    """A quantity as canonical integer text (``-5``, ``0``, ``12``); NULL if not a number.

    ``shape`` is the JSON type. It is looked at only if the text is not a plain integer, which
    means the same quoted and unquoted. The result is text so that any length works. Fractions
    of JSON numbers are cut, text with a fraction is not an integer.
    """
    odd = let(F.struct(text.alias("text"), shape.alias("shape")), lambda v: _odd_whole(v["text"], v["shape"]))
    return F.when(text.try_cast("bigint").cast("string") == text, text).otherwise(odd)


def _odd_whole(text: Column, shape: Column) -> Column:
    kind, number = kind_of_shape(shape), text.try_cast("double")
    cut = F.when(
        F.abs(number) < float("inf"),
        F.coalesce(
            number.try_cast("bigint").cast("string"), number.try_cast("decimal(38,0)").cast("string"), text
        ),
    )
    digits = (
        F.when(kind == "int", text)
        .when(kind == "bool", F.when(text == "true", "1").otherwise("0"))
        .when((kind == "str") & text.rlike(INTEGER_TEXT), F.regexp_replace(text, r"[^0-9-]", ""))
        .when(kind == "float", cut)
    )
    bare = F.regexp_replace(digits, r"^(-?)0+(?=\d)", "$1")
    return F.when(bare == "-0", "0").otherwise(bare)


def is_positive_whole(whole: Column) -> Column:
    return ~(whole.startswith("-") | (whole == "0"))


def finite_double(text: Column, shape: Column) -> Column:
    """A price as a double; NULL if not a number or not finite.

    ``shape`` is the JSON type, looked at only if the text is not a plain decimal.
    """
    odd = let(F.struct(text.alias("text"), shape.alias("shape")), lambda v: _odd_double(v["text"], v["shape"]))
    is_plain = text.rlike(r"^-?[0-9]+(?:\.[0-9]+)?\z")
    return F.when(is_plain, _finite(text.try_cast("double"))).otherwise(odd)


def _finite(number: Column) -> Column:
    return F.when(F.abs(number) < float("inf"), number)


def _odd_double(text: Column, shape: Column) -> Column:
    kind = kind_of_shape(shape)
    plain = F.regexp_replace(text, r"[^0-9.eE+-]", "")
    return (
        F.when(kind.isin("int", "float"), _finite(text.try_cast("double")))
        .when(kind == "bool", F.when(text == "true", 1.0).otherwise(0.0))
        .when((kind == "str") & text.rlike(FLOAT_TEXT), _finite(plain.try_cast("double")))
    )


_EDGE = r"[\x00-\x20\x7f]*"
_CUTTABLE = rf"^{_EDGE}(?:([+-]?[0-9]+)(?:\.[0-9]*)?|[+-]?\.[0-9]*){_EDGE}\z"


def lenient_int(text: Column) -> Column:
    """Decimal text to INT, cutting the fraction; anything else is NULL instead of an error."""
    whole = F.coalesce(F.nullif(F.regexp_extract(text, _CUTTABLE, 1), F.lit("")), F.lit("0"))
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(_CUTTABLE), whole.try_cast("int")))


def accepted_int(text: Column) -> Column:
    """``lenient_int`` and, beyond it, every spelling of a quantity that validation accepts."""
    plain = F.when(text.rlike(INTEGER_TEXT), F.regexp_replace(text, r"[^0-9-]", "").try_cast("int"))
    flag = F.when(text == "true", 1).when(text == "false", 0)
    number = text.try_cast("double")
    cut = F.when(F.abs(number) < 2147483648.0, number.cast("bigint").try_cast("int"))
    return F.coalesce(lenient_int(text), plain, flag, cut)


def accepted_double(text: Column) -> Column:
    """Every spelling of a price that validation accepts."""
    plain = F.when(text.rlike(FLOAT_TEXT), F.regexp_replace(text, r"[^0-9.eE+-]", "").try_cast("double"))
    flag = F.when(text == "true", 1.0).when(text == "false", 0.0)
    return F.coalesce(text.try_cast("double"), plain, flag)


def cents(amount: Column) -> Column:
    """Round an average to cents, first settling noise left by the order of summation."""
    return F.round(F.round(amount, 9), 2)


def exact_sum(amount: Column) -> Column:
    """Sum of amounts in cents, the same whatever the order of rows; NULL if there is none.

    Amounts are added as decimals and only the total is a double again. An amount beyond 26 digits,
    which has no cents left as a double, is added as a double.
    """
    exact = amount.try_cast("decimal(28,2)")
    huge = F.sum(F.when(exact.isNull(), amount))
    return F.coalesce(F.sum(exact).cast("double") + F.coalesce(huge, F.lit(0.0)), huge)
