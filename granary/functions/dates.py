"""Month arithmetic, lenient date parsing and time-zone stripping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_date(value) -> Column:
    """A DATE column from a column, a ``date`` or an ISO string."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def stamp(value: dt.datetime | str, kind="timestamp") -> Column:
    """A stamp literal that means the same wall-clock time on every machine.

    A Python datetime given to Spark as it is takes the time zone of the driver's process; its text takes that of the session.
    """
    return F.lit(value if isinstance(value, str) else value.isoformat(" ")).cast(kind)


def month_start(value) -> Column:
    """First day of the month, as DATE (``date_trunc`` would give a timestamp)."""
    column = F.col(value) if isinstance(value, str) else value
    return F.trunc(column.cast("date"), "MM")


def month_number(column: Column) -> Column:
    """Months counted from year 0, so that neighbouring months differ by one."""
    return F.year(column) * 12 + F.month(column)


def in_month(column: Column, month) -> Column:
    """``month <= column < month + 1 month``."""
    first = as_date(month)
    return (column >= first) & (column < F.add_months(first, 1))


def in_trailing_year(column: Column, month) -> Column:
    """``month - 12 months < column <= month``."""
    last = as_date(month)
    return (column > F.add_months(last, -12)) & (column <= last)


def trailing_months(as_of: dt.date, count: int = 12) -> list[dt.date]:
    """First days of the month of ``as_of`` and of the ``count - 1`` months before it."""
    last = as_of.year * 12 + as_of.month - 1
    return [dt.date((last - i) // 12, (last - i) % 12 + 1, 1) for i in range(count)]


def dotted_date(column: Column) -> Column:
    """DATE from ``dd.mm.yyyy`` text, NULL where the text is no such date."""
    return F.try_to_timestamp(column, F.lit("dd.MM.yyyy")).cast("date")


def timestamp_or_null(column: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """TIMESTAMP from text, NULL where it cannot be read."""
    return F.try_to_timestamp(column, F.lit(pattern))


def without_zone(column: Column) -> Column:
    """Wall-clock value with the zone stripped, for comparing stamps of mixed origin."""
    return column.cast("timestamp_ntz")


def formatted(column: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(column, pattern)
