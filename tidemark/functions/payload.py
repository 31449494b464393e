"""Reading untrusted JSON text strictly.

Spark's JSON parsers stop after the first complete value, so ``{"a":1} junk`` parses. To see
the whole text, a payload is parsed as the first element of an array whose second element is
a fingerprint of the payload: the fingerprint is found there only if the payload is exactly
one JSON value.

Fields are read in one pass as text. The JSON types, needed for unusual values only, come
from a VARIANT parse of those rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"
JSON_SPACE = " \t\n\r"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _body(text: Column) -> Column:
    return F.when(text.startswith(BYTE_ORDER_MARK), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def _mark(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def read_fields(text: Column, names) -> Column:
    """``array<struct>``: the payload's fields as text, then the fingerprint.

    A field is NULL when absent or JSON null, and JSON text when nested.
    """
    schema = "array<struct<" + ", ".join(f"{n}: string" for n in (*names, "_mark")) + ">>"
    sealed = F.concat(F.lit("["), _body(text), F.lit(',{"_mark":"'), _mark(text), F.lit('"}]'))
    return F.from_json(F.when(F.is_valid_utf8(text), sealed), schema, _STRICT)


def is_sealed(fields: Column, text: Column) -> Column:
    """Whether ``read_fields`` saw the fingerprint; never true for a broken payload."""
    return F.coalesce(F.get(fields, F.lit(1))["_mark"] == _mark(text), F.lit(False))


def is_single_value(text: Column) -> Column:
    """Whether the payload is exactly one JSON value of any type."""
    sealed = F.try_parse_json(F.concat(F.lit("["), _body(text), F.lit(","), _mark(text), F.lit("]")))
    mark = F.try_variant_get(sealed, "$[1]", "string")
    return F.coalesce(F.is_valid_utf8(text) & (mark == _mark(text)), F.lit(False))


def field_shape(text: Column, name: str) -> Column:
    """``schema_of_variant`` of one field of a payload object."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(_body(text)), f"$.{name}", "variant"))


def top_level_kind(text: Column) -> Column:
    """Type name of a payload already known to be one JSON value, from its first character."""
    start = F.ltrim(F.ltrim(text, F.lit(BYTE_ORDER_MARK)), F.lit(JSON_SPACE))
    first = F.left(start, F.lit(1))
    return (
        F.when(first == "{", "dict")
        .when(first == "[", "list")
        .when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "n", "NoneType")
        .when(start.rlike("[.eE]"), "float")
        .otherwise("int")
    )


def is_wide_integer(shape: Column) -> Column:
    """Whole numbers beyond 64 bits arrive as wide decimals without a fraction."""
    return shape.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$")


def kind_of_shape(shape: Column) -> Column:
    """Type name, as the reject details spell it, of a ``schema_of_variant`` result."""
    return (
        F.when(shape == "BIGINT", "int")
        .when(shape == "STRING", "str")
        .when(shape.startswith("DECIMAL("), F.when(is_wide_integer(shape), "int").otherwise("float"))
        .when(shape == "BOOLEAN", "bool")
        .when(shape == "VOID", "NoneType")
        .when(shape.startswith("OBJECT"), "dict")
        .when(shape.startswith("ARRAY"), "list")
        .otherwise("float")
    )


def display_text(kind: Column, text: Column) -> Column:
    """Scalar as the details show it: True/False, 1.0; strings and nested values as they are."""
    return (
        F.when(kind == "bool", F.initcap(text))
        .when(kind == "float", float_text(text.try_cast("double")))
        .otherwise(text)
    )


def float_text(number: Column) -> Column:
    """Shortest text of a double: positional from 1e-4 up to 1e16, else ``1.5e-07`` style."""
    shortest = number.cast("string")
    size = F.abs(number)
    positional = F.regexp_replace(number.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    mantissa = F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0$", "")
    power = F.substring_index(shortest, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.lit("e"),
        F.when(power < 0, "-").otherwise("+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"),
    )
    return (
        F.when(~shortest.contains("E"), shortest)
        .when(
            (size >= 1e-4) & (size < 1e16),
            F.when(positional.endswith("."), F.concat(positional, F.lit("0"))).otherwise(positional),
        )
        .otherwise(scientific)
    )
