"""Tests on data, freshness, alerts and service levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import hours_between, instant
from tidemark.functions.values import ratio

# Pass-rate targets by tier; alert thresholds.
TIER_TARGETS = {1: 0.99, 2: 0.98, 3: 0.95}
STALE_HOURS, SYNC_LAG_MINUTES = 6, 120


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"between_{self.column}"

    def fails(self) -> Column:
        """Out of range; a null passes."""
        c, bad = F.col(self.column), F.lit(False)
        if self.low is not None:
            bad = bad | (c < self.low)
        if self.high is not None:
            bad = bad | (c > self.high)
        return F.coalesce(bad, F.lit(False))


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return "unique_" + "_".join(self.columns)


Test = NotNull | Between | Unique


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(NotNull(column).fails())


def between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.filter(Between(column, low, high).fails())


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their count; keys with a null are left out."""
    complete = df
    for c in columns:
        complete = complete.filter(F.col(c).isNotNull())
    return complete.groupBy(*columns).agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df, [column])


def failing_rows(df: DataFrame, test: Test) -> DataFrame:
    """What a stored failure table holds: offending rows, or duplicated keys."""
    if isinstance(test, Unique):
        return unique_combination(df, test.columns)
    return df.filter(test.fails())


def store_failures(df: DataFrame, test: Test, path: str) -> None:
    failing_rows(df, test).write.mode("overwrite").parquet(f"{path}/{test.name}")


def run_suite(tables: Mapping[str, DataFrame], tests: Mapping[str, Sequence[Test]],
              tiers: Mapping[str, int]) -> DataFrame:
    """One row per test: table, test, tier, failures, status.

    The row tests of a table and its first uniqueness test share one pass: rows are counted
    per key with map-side combine, and the per-key counts are added up.  A table is thus
    computed once, however it was derived; further uniqueness tests take a pass each.
    """
    result = None
    for table, checks in tests.items():
        by_row = [t for t in checks if not isinstance(t, Unique)]
        by_key = [t for t in checks if isinstance(t, Unique)]
        parts = [_counted(tables[table], by_row, by_key[0] if by_key else None)]
        parts += [_counted(tables[table], [], t) for t in by_key[1:]]
        for part in parts:
            rows = part.select(F.lit(table).alias("table_name"), "test_name",
                               F.lit(tiers.get(table, 3)).alias("tier"), "failures",
                               F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"))
            result = rows if result is None else result.unionByName(rows)
    return result


def _counted(df: DataFrame, by_row: Sequence[Test], by_key: Unique | None) -> DataFrame:
    """(test_name, failures) of several row tests and at most one uniqueness test."""
    none = F.lit(0).cast("bigint")
    fails = [F.count(F.when(t.fails(), 1)).alias(t.name) for t in by_row]
    if by_key is None:
        counted = df.agg(*fails)
    else:
        complete = F.lit(True)
        for c in by_key.columns:
            complete = complete & F.col(c).isNotNull()
        repeated = F.count(F.when(complete & (F.col("_n") > 1), 1)).alias(by_key.name)
        counted = (df.groupBy(*by_key.columns).agg(F.count("*").alias("_n"), *fails)
                   .agg(repeated, *[F.coalesce(F.sum(f"`{t.name}`"), none).alias(t.name) for t in by_row]))
    names = [t.name for t in by_row] + ([by_key.name] if by_key else [])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("test_name"), F.col(f"`{n}`").alias("failures")) for n in names])).alias("r")).select("r.*")


def pass_rate(results: DataFrame) -> DataFrame:
    """Share of passed tests per tier against the tier's target."""
    target = F.create_map(*[F.lit(x) for kv in TIER_TARGETS.items() for x in kv])[F.col("tier")]
    return (results.groupBy("tier").agg(F.count("*").alias("tests"),
                                        F.count(F.when(F.col("status") == "pass", 1)).alias("passed"))
            .withColumn("pass_rate", ratio(F.col("passed"), F.col("tests")))
            .withColumn("target", target).withColumn("meets_target", F.col("pass_rate") >= F.col("target")))


def freshness(sources: Mapping[str, DataFrame], loaded_at: str, as_of: datetime | str,
              warn_hours: float = 12, error_hours: float = 24) -> DataFrame:
    """Age of the newest row of each source: pass, warn or error.  An empty source is an error."""
    result = None
    for name, df in sources.items():
        age = hours_between(F.col("max_loaded_at"), instant(as_of))
        row = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"), "max_loaded_at", age.alias("age_hours"),
            F.when(F.col("max_loaded_at").isNull() | (age > error_hours), "error")
            .when(age > warn_hours, "warn").otherwise("pass").alias("status"))
        result = row if result is None else result.unionByName(row)
    return result


def alert_rules(fresh: DataFrame, results: DataFrame) -> DataFrame:
    """Alerts out of freshness and test results.

    P1 for a source older than 6 hours, P1 for a failed tier-1 test, P2 for a sync lag above
    120 minutes.
    """
    empty = F.col("age_hours").isNull()
    rules = [
        (fresh, empty | (F.col("age_hours") > STALE_HOURS), "stale_source", "P1", F.col("source_name")),
        (fresh, empty | (F.col("age_hours") * 60 > SYNC_LAG_MINUTES), "sync_lag", "P2", F.col("source_name")),
        (results, (F.col("tier") == 1) & (F.col("status") == "fail"), "tier1_test_failure", "P1",
         F.concat_ws(".", "table_name", "test_name")),
    ]
    result = None
    for df, condition, rule, severity, subject in rules:
        hit = df.filter(condition).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                                          subject.alias("subject"))
        result = hit if result is None else result.unionByName(hit)
    return result


def sla_hit_rate(runs: DataFrame, deadlines: Mapping[int, str]) -> DataFrame:
    """Share of runs per tier that ended by the deadline, a time of day like ``06:00:00``.

    ``runs`` has tier, run_date and ended_at; a run that never ended missed its deadline.
    """
    limit = F.create_map(*[F.lit(x) for kv in deadlines.items() for x in kv])[F.col("tier")]
    due = F.concat_ws(" ", F.col("run_date").cast("string"), limit).cast("timestamp_ntz")
    on_time = F.coalesce(F.col("ended_at").cast("timestamp_ntz") <= due, F.lit(False))
    return (runs.groupBy("tier").agg(F.count("*").alias("runs"), F.count(F.when(on_time, 1)).alias("on_time"))
            .withColumn("sla_hit_rate", ratio(F.col("on_time"), F.col("runs"))))


def usage_cost(log: DataFrame, by: str, credits: str, failed: Column) -> DataFrame:
    """Requests, credits and error rate per warehouse (or metric)."""
    return (log.groupBy(by).agg(F.count("*").alias("requests"), F.sum(credits).alias("credits"),
                                F.count(F.when(failed, 1)).alias("errors"))
            .withColumn("error_rate", ratio(F.col("errors"), F.col("requests"))))


def queue_time(load: DataFrame, as_of: datetime | str, hours: int = 4) -> DataFrame:
    """Mean queue time per warehouse over the last hours, longest first."""
    at = F.col("start_time").cast("timestamp_ntz")
    recent = load.filter(at >= instant(as_of) - F.expr(f"interval {int(hours)} hours"))
    return (recent.groupBy("warehouse_name").agg(ratio(F.sum("queued_ms"), F.count("queued_ms")).alias("avg_queue"))
            .orderBy(F.desc("avg_queue"), "warehouse_name"))


def row_count_anomaly(df: DataFrame, date_column: str, window: int = 7, threshold: float = 3.0) -> DataFrame:
    """Daily row counts whose z-score against the ``window`` days before exceeds ``threshold``.

    The rows are reduced to one per day first; the ordered window runs over days.
    """
    daily = df.groupBy(F.col(date_column).alias("day")).agg(F.count("*").alias("row_count"))
    before = Window.orderBy("day").rowsBetween(-window, -1)
    n, total = F.count("row_count").over(before), F.sum("row_count").over(before)
    squares = F.sum(F.col("row_count") * F.col("row_count")).over(before)
    # Integer sums keep the variance exact until the last step.
    variance = ratio(n * squares - total * total, n * (n - 1))
    scored = daily.select("day", "row_count", ratio(total, n).alias("mean_before"),
                          F.when(n > 1, F.sqrt(variance)).alias("sd_before"))
    z = (F.col("row_count") - F.col("mean_before")) / F.nullif(F.col("sd_before"), F.lit(0.0))
    return scored.withColumn("z_score", z).withColumn("is_anomaly", F.coalesce(F.abs(z) > threshold, F.lit(False)))
