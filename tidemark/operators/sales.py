"""Pipeline, win rate, bookings, quota and stage movement."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import day, days_between, period_start
from tidemark.functions.values import percent_of, ratio
from tidemark.operators.ordering import with_next


def open_pipeline_filter(opportunities: DataFrame) -> DataFrame:
    """Open opportunities; an unknown ``is_closed`` is not open."""
    return opportunities.filter(~F.col("is_closed"))


def pipeline_snapshot(opportunities: DataFrame, as_of: date | str) -> DataFrame:
    return open_pipeline_filter(opportunities).select(
        day(as_of).alias("snapshot_date"), "opportunity_id", "account_id", "stage_name", "amount_usd",
        "probability_pct", percent_of(F.col("amount_usd"), F.col("probability_pct")).alias("weighted_amount_usd"),
        "is_closed", "is_won", "close_date", "owner_id")


def _closed_totals(closed: DataFrame, keys: Sequence) -> DataFrame:
    won = F.col("is_won")
    return closed.groupBy(*keys).agg(
        F.count(F.when(won, 1)).alias("won_count"),
        F.count(F.when(~won, 1)).alias("lost_count"),
        F.count("*").alias("closed_count"),
        F.sum(F.when(won, F.col("amount_usd")).otherwise(0)).alias("won_amount_usd"))


def _rates(totals: DataFrame) -> DataFrame:
    return (totals.withColumn("win_rate", ratio(F.col("won_count"), F.col("closed_count")))
            .withColumn("avg_deal_size_usd", ratio(F.col("won_amount_usd"), F.col("won_count"))))


def win_rate(opportunities: DataFrame) -> DataFrame:
    """Per close quarter; an unknown ``is_won`` counts as closed only."""
    quarter = period_start(F.col("close_date"), "quarter").alias("fiscal_quarter")
    totals = _closed_totals(opportunities.filter("is_closed"), [quarter])
    return _rates(totals).select("fiscal_quarter", "won_count", "lost_count", "closed_count", "win_rate",
                                 "avg_deal_size_usd", "won_amount_usd")


def win_rate_cube(opportunities: DataFrame, accounts: DataFrame) -> DataFrame:
    """Win rate for every combination of segment, region, product line and quarter.

    Counts and sums are additive, so opportunities are reduced to account x line x quarter
    before the join and to the finest cell before the cube expands its 16 grouping sets.
    """
    quarter = period_start(F.col("close_date"), "quarter").alias("fiscal_quarter")
    reduced = _closed_totals(opportunities.filter("is_closed"),
                             ["account_id", F.col("opportunity_type").alias("product_line"), quarter])
    dims = accounts.select("account_id", F.col("industry").alias("segment"), F.col("billing_country").alias("region"))
    measures = ["won_count", "lost_count", "closed_count", "won_amount_usd"]
    cell = (reduced.join(dims, "account_id", "inner")
            .groupBy("segment", "region", "product_line", "fiscal_quarter")
            .agg(*[F.sum(m).alias(m) for m in measures]))
    cubed = (cell.cube("segment", "region", "product_line", "fiscal_quarter")
             .agg(F.grouping_id().alias("grouping_level"), *[F.sum(m).alias(m) for m in measures]))
    return _rates(cubed)


def bookings(opportunities: DataFrame, grain: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Signed value per close period."""
    return (opportunities.filter("is_won")
            .groupBy(period_start(F.col("close_date"), grain).alias("period"), *by)
            .agg(F.count("*").alias("deals"), F.sum("amount_usd").alias("bookings_usd")))


def average_contract_value(opportunities: DataFrame, grain: str = "quarter") -> DataFrame:
    return bookings(opportunities, grain).withColumn(
        "acv_usd", ratio(F.col("bookings_usd"), F.col("deals")))


def sales_cycle(opportunities: DataFrame, grain: str = "quarter") -> DataFrame:
    """Days from creation to a won close.

    The exact median keeps one counter per distinct whole day, so its state is bounded by
    the longest cycle and not by the number of deals.
    """
    won = opportunities.filter("is_won").select(
        period_start(F.col("close_date"), grain).alias("period"),
        days_between(F.col("created_at").cast("date"), F.col("close_date")).alias("days"))
    return won.groupBy("period").agg(
        F.count("days").alias("deals"), ratio(F.sum("days"), F.count("days")).alias("avg_days"),
        F.percentile("days", 0.5).alias("median_days"))


def quota_attainment(opportunities: DataFrame, quotas: DataFrame) -> DataFrame:
    """Bookings over quota per owner and quarter; owners without bookings show zero."""
    booked = bookings(opportunities, "quarter", ["owner_id"]).withColumnRenamed("period", "quarter_start")
    return quotas.join(booked, ["owner_id", "quarter_start"], "left").select(
        "owner_id", "quarter_start", "quota_usd",
        F.coalesce("bookings_usd", F.lit(0)).alias("bookings_usd"),
        ratio(F.coalesce("bookings_usd", F.lit(0)), F.col("quota_usd")).alias("attainment"))


def weighted_forecast(opportunities: DataFrame, grain: str = "quarter") -> DataFrame:
    """Probability-weighted amounts by expected close period."""
    weighted = percent_of(F.col("amount_usd"), F.col("probability_pct"))
    return (opportunities.groupBy(period_start(F.col("close_date"), grain).alias("period"))
            .agg(F.sum(weighted).alias("forecast_usd")))


def forecast_accuracy(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """``|forecast - actual| / actual`` per period."""
    return forecast.join(actual, "period", "inner").select(
        "period", "forecast_usd", F.col("bookings_usd").alias("actual_usd"),
        ratio(F.abs(F.col("forecast_usd") - F.col("bookings_usd")), F.col("bookings_usd")).alias("error_share"))


def pipeline_coverage(opportunities: DataFrame, quotas: DataFrame, target: float = 3.0) -> DataFrame:
    """Open pipeline against quota per owner and quarter."""
    open_amounts = (open_pipeline_filter(opportunities)
                    .groupBy("owner_id", period_start(F.col("close_date"), "quarter").alias("quarter_start"))
                    .agg(F.sum("amount_usd").alias("pipeline_usd")))
    pipeline = F.coalesce("pipeline_usd", F.lit(0))
    coverage = ratio(pipeline, F.col("quota_usd"))
    return quotas.join(open_amounts, ["owner_id", "quarter_start"], "left").select(
        "owner_id", "quarter_start", "quota_usd", pipeline.alias("pipeline_usd"),
        coverage.alias("coverage"), (coverage >= target).alias("is_covered"))


def stage_conversion(history: DataFrame, order: Sequence[str] = ("changed_at", "version", "stage_name", "amount"),
                     width: str = "hour") -> DataFrame:
    """How often each stage is followed by each other one, and by nothing."""
    moves = (with_next(history, "opportunity_id", order, ["stage_name"], width)
             .groupBy("stage_name", "next_stage_name").agg(F.count("*").alias("moves")))
    left = moves.groupBy("stage_name").agg(F.sum("moves").alias("stage_rows"))
    return moves.join(left, "stage_name").select(
        "stage_name", "next_stage_name", "moves", ratio(F.col("moves"), F.col("stage_rows")).alias("share"))
