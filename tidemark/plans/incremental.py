"""Marts that are kept up to date from landed loads.

A mart by period knows which loads it holds.  A refresh reads the new loads only, reduces them to parts that add up (kept per
period and load), and builds the periods that a new load touches again from their parts.  A late load
touches old periods, a load landed again replaces its own parts, and a repeated refresh changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import period_start
from tidemark.operators import product, sketches
from tidemark.session import checkpointed
from tidemark.sources.landing import balanced

_PERIOD, _LOAD = "_period", "_load"


@dataclass(frozen=True)
class Mart:
    """How a mart comes from landed rows.

    ``parts`` turns rows with a column ``dt`` (their load) into parts that keep ``dt`` and hold ``date_column``; ``finish`` turns the
    parts of whole periods into rows of the mart, which hold ``date_column`` too.
    """

    parts: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]
    date_column: str


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: the loads it read and the periods it built again."""

    loads: list[date] = field(default_factory=list)
    periods: list[date] = field(default_factory=list)


# A sketch of users per day and account; what ``metrics.distinct_metric`` reads.
ACTIVE_USERS = Mart(lambda events: sketches.distinct_parts(events, ["dt"]), sketches.merge_distinct, "activity_date")
ENGAGEMENT = Mart(lambda events: product.engagement_parts(events, ["dt"]), product.engagement_of_parts, "activity_date")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _replace(df: DataFrame, path: str, *columns: str) -> None:
    (balanced(df, columns[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def _dates(df: DataFrame, column: str) -> set[date]:
    """Distinct dates: one number per period or load, not per row."""
    return {r[0] for r in df.select(column).distinct().collect()}


def new_loads(spark: SparkSession, landed: str, mart: str) -> DataFrame:
    """``dt, completed_at`` of complete loads that the mart does not hold, or holds as they were before."""
    done = spark.read.schema("dt date, completed_at timestamp_ntz").parquet(f"{landed}/manifest")
    if not _exists(spark, f"{mart}/held"):
        return done
    held = spark.read.schema("dt date, completed_at timestamp_ntz").parquet(f"{mart}/held")
    return done.join(held, ["dt", "completed_at"], "left_anti")


def new_rows(spark: SparkSession, landed: str, loads: list[date]) -> DataFrame:
    """The rows of some loads; the partition filter keeps the scan to their folders."""
    return spark.read.parquet(f"{landed}/data").filter(F.col("dt").isin(*loads))


def refresh(spark: SparkSession, landed: str, mart: str, spec: Mart, grain: str = "month") -> Refreshed:
    """Bring the mart below ``mart`` up to date with the loads landed below ``landed``.

    The mart is written by ``grain``; give the same one every time.  Loads are marked as held last, and the periods to be built
    are noted before anything changes, so a refresh that broke off is made good by the next one.
    """
    fresh = checkpointed(new_loads(spark, landed, mart), "new-loads")
    loads = sorted(_dates(fresh, "dt"))
    noted = f"{mart}/noted"
    periods = _dates(spark.read.schema("period date").parquet(noted), "period") if _exists(spark, noted) else set()
    if not loads and not periods:
        return Refreshed()
    parts = f"{mart}/parts"
    stored = spark.read.parquet(parts) if _exists(spark, parts) else None
    if loads:
        made = spec.parts(new_rows(spark, landed, loads))
        made = checkpointed(made.withColumns({_PERIOD: period_start(F.col(spec.date_column), grain), _LOAD: F.col("dt")}).drop("dt"),
                            "parts")
        places = {tuple(r) for r in made.select(_PERIOD, _LOAD).distinct().collect()}
        before = set() if stored is None else {
            tuple(r) for r in stored.filter(F.col(_LOAD).isin(*loads)).select(_PERIOD, _LOAD).distinct().collect()}
        periods |= {p for p, _ in places | before}
        _note(spark, noted, periods)
        _replace(made, parts, _PERIOD, _LOAD)
        for period, load in sorted(before - places):
            _remove(spark, f"{parts}/{_PERIOD}={period}/{_LOAD}={load}")
    touched = sorted(periods)
    if _exists(spark, parts) and touched:
        rows = spec.finish(spark.read.parquet(parts).filter(F.col(_PERIOD).isin(*touched)).drop(_PERIOD, _LOAD))
        built = checkpointed(rows.withColumn(_PERIOD, period_start(F.col(spec.date_column), grain)), "mart-periods")
        _replace(built, f"{mart}/rows", _PERIOD)
        for period in sorted(set(touched) - _dates(built, _PERIOD)):
            _remove(spark, f"{mart}/rows/{_PERIOD}={period}")
    if loads:
        _replace(fresh, f"{mart}/held", "dt")
    _remove(spark, noted)
    return Refreshed(loads, touched)


def _note(spark: SparkSession, path: str, periods: set[date]) -> None:
    spark.createDataFrame([(p,) for p in sorted(periods)], "period date").write.mode("overwrite").parquet(path)


def read_mart(spark: SparkSession, mart: str) -> DataFrame:
    return spark.read.parquet(f"{mart}/rows").drop(_PERIOD)
