"""Number conversions with the rounding and NULL rules of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(column: Column) -> Column:
    """Fixed-point amount, so that sums do not depend on the order of the rows."""
    return column.cast(MONEY)


def whole(column: Column) -> Column:
    """Integer by rounding half away from zero; a plain cast would cut 2.5 to 2."""
    return F.round(column, 0).cast("int")


def number_or_null(column: Column, kind: str = "int") -> Column:
    """Number from text, NULL where the text is no number."""
    return column.try_cast(kind)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is 0."""
    return F.try_divide(numerator, denominator)
