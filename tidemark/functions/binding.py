"""Local names inside column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once however often ``body`` uses it.

    Meant for rare branches: a lambda is interpreted, which keeps the generated code of the
    common branch short enough for the JVM to compile.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def out_of_line(value: Column) -> Column:
    """The same value, kept out of the generated code of its projection; see ``let``."""
    return let(F.lit(0), lambda _: value)
