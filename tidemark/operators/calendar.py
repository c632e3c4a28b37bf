"""Calendars out of ``sequence``: no row generator, no gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import day, period_start, periods

def spine(spark: SparkSession, start: date | str, end: date | str, grain: str = "day",
          name: str = "date_day") -> DataFrame:
    """Every period start from ``start``'s period to ``end``'s period, both included."""
    first, last = period_start(day(start), grain), period_start(day(end), grain)
    return spark.range(1).select(F.explode(
        F.when(day(start) <= day(end), periods(first, last, grain))).alias(name))


def date_range(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Inclusive days as ISO text, empty when ``end`` lies before ``start``."""
    return spine(spark, start, end).select(F.date_format("date_day", "yyyy-MM-dd").alias("day"))


def time_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Days from ``start`` up to, but without, ``end``."""
    return spine(spark, start, end).filter(F.col("date_day") < day(end))


def month_spine(spark: SparkSession, start: date | str, as_of: date | str) -> DataFrame:
    """First days of months inside ``[start, as_of]``."""
    return spine(spark, start, as_of, "month", "revenue_month").filter(
        F.col("revenue_month") >= day(start))


def dim_date(spark: SparkSession, as_of: date | str, start: date | str = "2018-01-01",
             days: int | None = None, fiscal_start: int = 1) -> DataFrame:
    """Every day from ``start`` to two years after ``as_of``, or at most ``days`` of them.

    The fiscal year carries the calendar year in which it ends; with ``fiscal_start=1``
    it is the calendar year.
    """
    last = F.add_months(day(as_of), 24)
    if days is not None:
        last = F.least(F.date_add(day(start), days - 1), last)
    listed = spark.range(1).select(F.explode(periods(day(start), last)).alias("date_day"))
    # Shift the calendar so that the fiscal year starts in January of the shifted one.
    shifted = F.add_months(F.col("date_day"), (13 - fiscal_start) % 12)
    shifted_month = F.trunc(F.add_months(F.trunc("date_day", "month"), (13 - fiscal_start) % 12), "month")
    return listed.select(
        "date_day",
        F.trunc("date_day", "month").alias("month_start"),
        F.trunc("date_day", "quarter").alias("quarter_start"),
        F.year(shifted).alias("fiscal_year"),
        F.quarter(shifted).alias("fiscal_quarter"),
        ((F.month(shifted_month) == 12) & (F.col("date_day") == F.last_day("date_day")))
        .alias("is_fiscal_year_end"),
    )


def fill_gaps(series: DataFrame, calendar: DataFrame, period: str, values: list[str],
              fill: float | int = 0) -> DataFrame:
    """One row for each period of ``calendar`` (column ``period``); missing values become ``fill``.

    Both sides are already aggregated to one row per period.
    """
    joined = calendar.select(period).join(series, period, "left")
    return joined.select(period, *[F.coalesce(F.col(v), F.lit(fill)).cast(series.schema[v].dataType).alias(v)
                                   for v in values])
