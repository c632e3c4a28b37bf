"""Distinct counts and quantiles that merge: a sketch per day and key is stored, and any period or split unites the stored ones.

Counts of distinct users do not add up and neither do medians; sketches of them do.  A sketch has a fixed size, whatever it
has seen, so a year over all accounts reads one small row per day and account and no events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import period_start
from tidemark.operators.relational import not_in_events

# 2**LG_K registers in a count sketch.
LG_K = 12
# Items that a level of a quantile sketch holds.
LEVEL = 800
# What the ranks of reported quantiles may be off by; about three times the error that a sketch of LEVEL has in 99 of 100 cases.
RANK_ERROR = 0.01


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a count from united sketches with ``2**lg_k`` registers."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_parts(events: DataFrame, by: Sequence[str] = (), user: str = "user_id", lg_k: int = LG_K) -> DataFrame:
    """``activity_date, account_id, by, users``: a sketch of the active users per day and account.

    Events count as in ``account_engagement``.  Sketches are built before the shuffle, so a dominant account
    sends one sketch per task and not its events.
    """
    active = not_in_events(events).filter(F.col(user).isNotNull())
    return active.groupBy(F.col("event_date").alias("activity_date"), "account_id", *by).agg(
        F.hll_sketch_agg(user, lg_k).alias("users"))


def merge_distinct(parts: DataFrame) -> DataFrame:
    """One sketch per day and account out of the parts of any number of loads; users that several loads hold count once."""
    return parts.groupBy("activity_date", "account_id").agg(F.hll_union_agg("users").alias("users"))


def distinct_users(parts: DataFrame, grain: str, dims: Sequence[str | Column] = (), lg_k: int = LG_K) -> DataFrame:
    """``period, dims, active_users, approximate, standard_error`` from stored parts, which carry the dimensions.

    ``standard_error`` is in users.  Periods without activity have no row.
    """
    united = parts.groupBy(period_start(F.col("activity_date"), grain).alias("period"), *dims).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).cast("bigint").alias("active_users"))
    return united.withColumns({"approximate": F.lit(True),
                               "standard_error": F.col("active_users") * F.lit(standard_error(lg_k))})


def quantile_parts(df: DataFrame, value: Column, at: Column, by: Sequence[str] = (), level: int = LEVEL) -> DataFrame:
    """``month, by, n, sketch``: a sketch of whole-numbered values per month of ``at``; rows without a value are left out."""
    rows = df.select(period_start(at, "month").alias("month"), *by, value.cast("bigint").alias("_v")).filter("_v is not null")
    return rows.groupBy("month", *by).agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint("_v", F.lit(level)).alias("sketch"))


def quantiles(parts: DataFrame, grain: str, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``period, by, n, probability, value, rank_error`` from stored monthly parts, united to months, quarters or years.

    The value stands at a rank within ``rank_error`` of the probability; up to ``LEVEL`` values it is exact, except that it is
    always one of the values and never a mean of two.
    """
    if grain not in ("month", "quarter", "year"):
        raise ValueError("monthly sketches unite to months, quarters or years")
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    united = parts.groupBy(period_start(F.col("month"), grain).alias("period"), *by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    rows = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_bigint(
        "sketch", F.lit(float(p))).alias("value")) for p in probabilities]))
    return united.select("period", *by, "n", rows.alias("q")).select(
        "period", *by, "n", "q.*", F.lit(RANK_ERROR).alias("rank_error"))
