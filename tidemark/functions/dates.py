"""Calendar arithmetic that always returns DATE, BIGINT days or zone-free timestamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def day(value: date | str | Column) -> Column:
    """A DATE column from a Python date, an ISO string or a column."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def instant(value: datetime | date | str | Column) -> Column:
    """A zone-free timestamp column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def period_start(value: Column, grain: str) -> Column:
    """First day of the day, week (Monday), month, quarter or year around ``value``."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; one of {GRAINS}")
    if grain == "day":
        return value.cast("date")
    return F.trunc(value.cast("date"), grain)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def months_later(start: Column, months: int) -> Column:
    return F.add_months(start, months)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with fractions, between zone-free timestamps."""
    seconds = F.timestamp_diff("SECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return seconds.cast("double") / 3600.0


def to_utc(value: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` as zone-free UTC time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), value.cast("timestamp_ntz"))


def micros(value: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", instant("1970-01-01"), value.cast("timestamp_ntz"))


def periods(first: Column, last: Column, grain: str = "day") -> Column:
    """Array of dates from ``first`` to ``last`` in steps of ``grain``; null (so no rows after
    an explode) when ``last`` lies before ``first``, where ``sequence`` alone would fail."""
    steps = {"day": "1 day", "week": "7 day", "month": "1 month", "quarter": "3 month", "year": "1 year"}
    return F.when(last >= first, F.sequence(first, last, F.expr(f"interval {steps[grain]}")))
