"""Headcount, attrition, hiring and reporting lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import day, days_between, period_start, periods
from tidemark.functions.values import ratio


def headcount(workers: DataFrame, as_of: date | str, cap_at_as_of: bool = False) -> DataFrame:
    """Per department: active workers, terminations since a month ago, mean tenure in days.

    As defined, terminations dated after ``as_of`` count too; ``cap_at_as_of`` leaves them out.
    """
    left = F.col("termination_date") >= F.add_months(day(as_of), -1)
    if cap_at_as_of:
        left = left & (F.col("termination_date") <= day(as_of))
    tenure = days_between(F.col("hire_date"), F.coalesce(F.col("termination_date"), day(as_of)))
    return workers.groupBy("department").agg(
        F.count(F.when(F.col("employment_status") == "Active", 1)).alias("headcount"),
        F.count(F.when(left, 1)).alias("terminations_last_month"),
        F.sum(tenure).alias("tenure_days"), F.count(tenure).alias("tenure_workers"),
    ).select(period_start(day(as_of), "month").alias("snapshot_month"), "department", "headcount",
             "terminations_last_month", ratio(F.col("tenure_days"), F.col("tenure_workers")).alias("avg_tenure_days"),
             "tenure_days", "tenure_workers")


def hr_rollup(departments: DataFrame) -> DataFrame:
    """Company totals per month.

    ``avg_tenure_days`` is the mean of department means, as defined;
    ``weighted_tenure_days`` is the mean over workers.
    """
    return departments.groupBy(F.col("snapshot_month").alias("activity_month")).agg(
        F.sum("headcount").alias("headcount"), F.sum("terminations_last_month").alias("terminations"),
        F.avg("avg_tenure_days").alias("avg_tenure_days"),
        ratio(F.sum("tenure_days"), F.sum("tenure_workers")).alias("weighted_tenure_days"))


def headcount_monthly(workers: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Month x department history out of hire and termination dates.

    ``headcount`` counts workers employed at the end of the month.  A worker adds one in
    the month of hire and takes one off in the month of termination, so the cost does not
    grow with tenure; per department the running sum sees one row per month.
    """
    opening, closing = period_start(day(start), "month"), period_start(day(as_of), "month")
    hired, left = period_start(F.col("hire_date"), "month"), period_start(F.col("termination_date"), "month")
    # greatest() skips nulls: a worker without a termination must not leave at the opening.
    ended = workers.filter(F.col("termination_date").isNotNull() & F.col("hire_date").isNotNull())
    started = workers.filter(F.col("hire_date").isNotNull())
    months = periods(opening, closing, "month")
    zero = {"change": F.lit(0), "hires": F.lit(0), "terminations": F.lit(0)}
    joins = started.select("department", F.greatest(hired, opening).alias("month"), F.lit(1).alias("change"),
                           F.when(hired >= opening, 1).otherwise(0).alias("hires"), F.lit(0).alias("terminations"))
    exits = ended.select("department", F.greatest(left, opening).alias("month"), F.lit(-1).alias("change"),
                         F.lit(0).alias("hires"), F.when(left >= opening, 1).otherwise(0).alias("terminations"))
    grid = (workers.select("department").distinct().withColumn("month", F.explode(months)).withColumns(zero))
    monthly = (joins.unionByName(exits).filter(F.col("month") <= closing).unionByName(grid)
               .groupBy("department", "month")
               .agg(F.sum("change").alias("change"), F.sum("hires").alias("hires"),
                    F.sum("terminations").alias("terminations")))
    to_date = Window.partitionBy("department").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return monthly.select("department", "month", F.sum("change").over(to_date).alias("headcount"), "hires",
                          "terminations", "change")


def employee_months(workers: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Employee x month from the month of hire to that of termination: department, cost center, FTE, and whether
    the employee is still there at the end of the month."""
    opening, closing = period_start(day(start), "month"), period_start(day(as_of), "month")
    first = F.greatest(period_start(F.col("hire_date"), "month"), opening)
    last = F.least(period_start(F.coalesce("termination_date", day(as_of)), "month"), closing)
    employed = workers.filter(F.col("hire_date").isNotNull() & (last >= first))
    listed = employed.withColumn("month", F.explode(periods(first, last, "month")))
    stays = F.col("termination_date").isNull() | (F.col("termination_date") > F.last_day("month"))
    return listed.select("employee_id", "month", "department", "cost_center", "fte", stays.alias("is_active"))


def attrition_avg(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Terminations over the mean of opening and closing headcount, per month (and ``by``, such as the department)."""
    total = history.groupBy("month", *by).agg(F.sum("headcount").alias("closing"), F.sum("change").alias("change"),
                                         F.sum("terminations").alias("terminations"))
    mean = (F.col("closing") + F.col("closing") - F.col("change")) / F.lit(2.0)
    return total.select("month", *by, "terminations", mean.alias("avg_headcount"),
                        ratio(F.col("terminations"), mean).alias("attrition_rate"))


def time_to_hire(requisitions: DataFrame) -> DataFrame:
    """Days from opening to acceptance per department.  The median's state is one counter per
    distinct day count."""
    filled = requisitions.filter(F.col("accepted_date").isNotNull()).select(
        "department", days_between(F.col("opened_date"), F.col("accepted_date")).alias("days"))
    return filled.groupBy("department").agg(
        F.count("*").alias("hires"), ratio(F.sum("days"), F.count("*")).alias("avg_days"),
        F.percentile("days", 0.5).alias("median_days"))


def open_reqs(requisitions: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Unfilled requisitions on each Monday of ``[start, end]``: a sweep over open and close days."""
    first, last = period_start(day(start), "week"), period_start(day(end), "week")

    def monday_from(d):  # the first Monday on or after a day
        return F.date_add(period_start(F.date_sub(d, 1), "week"), 7)

    opened = requisitions.filter(F.col("opened_date").isNotNull()).select(
        F.greatest(monday_from(F.col("opened_date")), first).alias("week"), F.lit(1).alias("change"))
    closed = requisitions.filter(F.col("opened_date").isNotNull() & F.col("accepted_date").isNotNull()).select(
        F.greatest(monday_from(F.greatest("accepted_date", "opened_date")), first).alias("week"),
        F.lit(-1).alias("change"))
    grid = (requisitions.sparkSession.range(1)
            .select(F.explode(periods(first, last, "week")).alias("week"), F.lit(0).alias("change")))
    weekly = (opened.unionByName(closed).filter(F.col("week") <= last).unionByName(grid)
              .groupBy("week").agg(F.sum("change").alias("change")))
    # One row per week: a window without partitions is fine here.
    return weekly.select("week", F.sum("change").over(
        Window.orderBy("week").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("open_reqs"))


def span_of_control(workers: DataFrame) -> DataFrame:
    """Direct reports per manager."""
    return (workers.filter(F.col("manager_id").isNotNull()).groupBy("manager_id")
            .agg(F.count("*").alias("direct_reports")))
