"""Account spine, recurring revenue, margin, reconciliation, currency and forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import day, instant, period_start, periods
from tidemark.functions.values import annual_cents, monthly_usd, ratio, yearly_usd
from tidemark.operators.relational import growth_rate, status_in
from tidemark.operators.skew import spread_join, spread_to_unfold

# Subscription states that count as revenue.
BILLABLE = ("active", "trialing", "past_due")


def account_customers(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Account x billing customer, accounts without a customer included.

    An account may own very many customers, and an outer join cannot split its optional
    side.  So matches come from an inner join with heavy accounts spread, and accounts
    without a match from an anti-join against distinct ids.
    """
    linked = customers.filter(F.col("salesforce_account_id").isNotNull()).select(
        F.col("salesforce_account_id").alias("account_id"), F.col("customer_id").alias("stripe_customer_id"))
    shown = accounts.select("account_id", "account_name", "industry", "account_type",
                            F.col("created_at").alias("account_created_at"))
    matched = spread_join(linked, shown, "account_id", spread_by=["stripe_customer_id"])
    alone = shown.join(linked.select("account_id").distinct(), "account_id", "left_anti").withColumn(
        "stripe_customer_id", F.lit(None).cast("string"))
    columns = ["account_id", "account_name", "industry", "account_type", "stripe_customer_id", "account_created_at"]
    return matched.select(*columns).unionByName(alone.select(*columns))


def account_spine(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per account, with its first billing customer and how many it has.

    Joining on this spine cannot multiply rows.  All customer ids stay available in
    ``account_customers``; they are not gathered into an array, whose length nothing bounds.
    """
    per_account = (customers.filter(F.col("salesforce_account_id").isNotNull())
                   .groupBy(F.col("salesforce_account_id").alias("account_id"))
                   .agg(F.min_by("customer_id", F.struct("created_at", "customer_id")).alias("stripe_customer_id"),
                        F.count("*").alias("stripe_customer_count")))
    return accounts.join(per_account, "account_id", "left").select(
        "account_id", "account_name", "industry", "account_type", "stripe_customer_id",
        F.coalesce("stripe_customer_count", F.lit(0)).alias("stripe_customer_count"),
        F.col("created_at").alias("account_created_at"))


def subscription_mrr(subscriptions: DataFrame, customers: DataFrame, accounts: DataFrame,
                     statuses: Sequence[str] | None = BILLABLE) -> DataFrame:
    """Billable subscriptions with their account and monthly price; one row per subscription.

    The customer-to-account link is built first, one row per customer by its newest record,
    so the large side is joined once and never fans out.
    """
    billable = subscriptions if statuses is None else status_in(subscriptions, "subscription_status", statuses)
    known = accounts.select("account_id", F.col("account_id").alias("salesforce_account_id")).distinct()
    newest = F.max_by("salesforce_account_id", F.struct("created_at", "salesforce_account_id"))
    link = (customers.groupBy("customer_id").agg(newest.alias("salesforce_account_id"))
            .join(known, "salesforce_account_id", "left").select("customer_id", "account_id"))
    cents = annual_cents(F.col("plan_amount_usd"), F.col("plan_interval"))
    return billable.join(link, "customer_id", "inner").select(
        "subscription_id", "account_id", "customer_id", "subscription_status", "plan_amount_usd",
        "plan_interval", monthly_usd(cents).alias("mrr_usd"), cents.alias("annual_cents"),
        "period_start_at", "period_end_at", "canceled_at", "created_at")


def _covered_months(rule: str) -> tuple[Column, Column]:
    """First and last month (first days) that a subscription counts in."""
    start = F.col("period_start_at")
    end = F.coalesce(F.col("canceled_at"), F.col("period_end_at"))
    if rule == "inclusive":
        return period_start(start, "month"), period_start(end, "month")
    if rule == "month_start":
        # Active at midnight of the first: start <= m < end.
        opening, closing = period_start(start, "month"), period_start(end, "month")
        first = F.when(opening.cast("timestamp_ntz") == start, opening).otherwise(F.add_months(opening, 1))
        last = F.when(closing.cast("timestamp_ntz") < end, closing).otherwise(F.add_months(closing, -1))
        return first, last
    raise ValueError(f"unknown rule {rule!r}")


def subscription_months(mrr: DataFrame, start: date | str, as_of: date | str,
                        rule: str = "inclusive") -> DataFrame:
    """Interval join of subscriptions with the months they cover, as an explode.

    The months of a subscription come from its own row, so no range predicate and no
    nested loop is needed to find them.
    """
    first, last = _covered_months(rule)
    inside = mrr.select("subscription_id", "account_id", "annual_cents",
                        F.greatest(first, day(start)).alias("_first"),
                        F.least(last, period_start(day(as_of), "month")).alias("_last"),
                        last.isNotNull().alias("_ends"))
    return (inside.filter(F.col("_ends") & (F.col("_last") >= F.col("_first")))
            .select("subscription_id", "account_id", "annual_cents",
                    F.explode(periods(F.col("_first"), F.col("_last"), "month")).alias("revenue_month")))


def account_month_grid(accounts: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Every account in every month; the months are exploded, not cross joined."""
    months = periods(period_start(day(start), "month"), period_start(day(as_of), "month"), "month")
    return (accounts.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
            .withColumn("revenue_month", F.explode(months)))


def _arr_changes(mrr: DataFrame, start: date | str, as_of: date | str, rule: str, include_trials: bool) -> DataFrame:
    """``account_id, month, change``: yearly cents that each subscription adds and takes off, two rows at most."""
    rows = mrr if include_trials else mrr.filter(F.col("subscription_status") != "trialing")
    first, last = _covered_months(rule)
    opening, closing = period_start(day(start), "month"), period_start(day(as_of), "month")
    spans = rows.select("account_id", F.col("annual_cents").alias("c"),
                        F.greatest(first, opening).alias("f"), last.alias("l"))
    changes = (
        spans.filter(F.col("account_id").isNotNull() & F.col("c").isNotNull() & (F.col("l") >= F.col("f")))
        .select("account_id", F.explode(F.array(
            F.struct(F.col("f").alias("month"), F.col("c").alias("change")),
            F.struct(F.add_months("l", 1).alias("month"), (-F.col("c")).alias("change")))).alias("s"))
        .select("account_id", "s.month", "s.change").filter(F.col("month") <= closing)
    )
    return changes


def arr_by_month(mrr: DataFrame, accounts: DataFrame, start: date | str, as_of: date | str,
                 rule: str = "inclusive", include_trials: bool = True) -> DataFrame:
    """``revenue_month, total_arr`` of all listed accounts.

    ARR adds up, so the changes of all accounts are summed by month and the running total sees one row per month;
    no account x month rows arise.
    """
    known = accounts.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
    changes = _arr_changes(mrr, start, as_of, rule, include_trials).join(known, "account_id", "left_semi")
    opening, closing = period_start(day(start), "month"), period_start(day(as_of), "month")
    # Without accounts there are no rows, as in the mart.
    months = known.agg(F.count("*").alias("n")).filter("n > 0").select(
        F.explode(periods(opening, closing, "month")).alias("month"), F.lit(0).cast("bigint").alias("change"))
    line = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = changes.select("month", "change").unionByName(months).groupBy("month").agg(F.sum("change").alias("change"))
    return summed.select(F.col("month").alias("revenue_month"), yearly_usd(F.sum("change").over(line)).alias("total_arr"))


def monthly_revenue(mrr: DataFrame, accounts: DataFrame, start: date | str, as_of: date | str,
                    rule: str = "inclusive", include_trials: bool = True) -> DataFrame:
    """Account x month with MRR and ARR, zero where nothing is billed.

    A sweep instead of an interval join: a subscription adds its yearly cents in its first
    month and takes them off after its last, so it costs two rows however long it runs.
    Changes are summed per (account, month) with map-side combine; the running sum then sees
    at most one row per month of an account, hot accounts included.  Only the shuffled rows
    are sparse: the months between two changes are filled in by an explode at the very end,
    inside the partitions that the running sum left behind.  These are many, as whoever groups the
    filled-in rows by account and month does so inside them as well.
    """
    opening, closing = period_start(day(start), "month"), period_start(day(as_of), "month")
    changes = _arr_changes(mrr, start, as_of, rule, include_trials)
    listed = accounts.select("account_id").filter(F.col("account_id").isNotNull()).distinct().select(
        "account_id", opening.alias("month"), F.lit(0).cast("bigint").alias("change"))
    summed = (
        changes.withColumn("is_listed", F.lit(False)).unionByName(listed.withColumn("is_listed", F.lit(True)))
        .groupBy("account_id", "month").agg(F.sum("change").alias("change"), F.max("is_listed").alias("is_listed"))
    )
    line = Window.partitionBy("account_id").orderBy("month")
    to_date = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steady = spread_to_unfold(summed, "account_id").select(
        "account_id", "month", F.sum("change").over(to_date).alias("cents"),
        F.max("is_listed").over(to_date).alias("is_listed"),
        F.coalesce(F.add_months(F.lead("month").over(line), -1), closing).alias("until"),
    ).filter("is_listed")
    return steady.select(
        "account_id", monthly_usd(F.col("cents")).alias("mrr_usd"), yearly_usd(F.col("cents")).alias("arr_usd"),
        F.explode(periods(F.col("month"), F.col("until"), "month")).alias("revenue_month"),
    ).select("account_id", "revenue_month", "mrr_usd", "arr_usd")


def total_arr(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("revenue_month").agg(F.sum("arr_usd").alias("total_arr"))


def net_revenue_retention(revenue: DataFrame, months: int = 12, grain: str = "quarter") -> DataFrame:
    """ARR now over ARR ``months`` ago, for accounts that paid then, at period ends.

    Accounts have a gap-free month series, so the base is a ``lag`` inside the partitioning
    by account that the revenue mart already has: no self-join.  The cohort is the year in
    which an account first paid.
    """
    line = Window.partitionBy("account_id").orderBy("revenue_month")
    whole = Window.partitionBy("account_id")
    based = (
        revenue.withColumn("base", F.lag("arr_usd", months).over(line))
        .withColumn("cohort_year", F.year(F.min(F.when(F.col("arr_usd") > 0, F.col("revenue_month"))).over(whole)))
        .filter((F.col("base") > 0)
                & (F.add_months("revenue_month", 1)
                   == period_start(F.add_months("revenue_month", 1), grain)))
    )
    return (
        based.groupBy("cohort_year", period_start(F.col("revenue_month"), grain).alias("period"))
        .agg(F.count("*").alias("base_accounts"), F.sum("base").alias("base_arr_usd"),
             F.sum("arr_usd").alias("current_arr_usd"))
        .withColumn("nrr", ratio(F.col("current_arr_usd"), F.col("base_arr_usd")))
    )


def gross_margin(transactions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue, cost and margin per month (and ``by``) in one scan.

    Only months with income appear; cost-only months do not.
    """
    income, cost = F.col("account_type") == "Income", F.col("account_type") == "COGS"
    totals = (
        transactions.filter(F.col("account_type").isin("Income", "COGS"))
        .groupBy(period_start(F.col("transaction_date"), "month").alias("revenue_month"), *by)
        .agg(F.count(F.when(income, 1)).alias("_income_rows"),
             F.sum(F.when(income, F.col("amount"))).alias("revenue_usd"),
             F.coalesce(F.sum(F.when(cost, F.col("amount"))), F.lit(0)).alias("cogs_usd"))
        .filter(F.col("_income_rows") > 0)
    )
    profit = F.col("revenue_usd") - F.col("cogs_usd")
    return totals.select("revenue_month", *by, "revenue_usd", "cogs_usd",
                         profit.alias("gross_profit_usd"),
                         ratio(profit, F.col("revenue_usd")).alias("gross_margin_pct"))


def segment_margin(transactions: DataFrame, accounts: DataFrame, segment: str = "industry",
                   by: Sequence[str] = ()) -> DataFrame:
    """Revenue, cost and margin per month, customer segment (a column of ``accounts``) and ``by``.

    Transactions name their ``account_id`` and are added up by account and month before they meet the accounts, so a
    busy account is one row per month in the join.  Transactions of unknown accounts have a null segment.
    """
    kinds = transactions.filter(F.col("account_type").isin("Income", "COGS"))
    added = kinds.groupBy("account_id", period_start(F.col("transaction_date"), "month").alias("transaction_date"),
                          "account_type", *by).agg(F.sum("amount").alias("amount"))
    segments = accounts.select("account_id", F.col(segment).alias("customer_segment"))
    return gross_margin(added.join(segments, "account_id", "left"), ["customer_segment", *by])


def customers_spine(customers: DataFrame, spine: DataFrame) -> DataFrame:
    """Billing customers with the name of their account; customers whose account is not on the spine keep a null name."""
    names = spine.select(F.col("account_id").alias("salesforce_account_id"), "account_name")
    return customers.join(names, "salesforce_account_id", "left").select("customer_id", "salesforce_account_id", "account_name")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str,
              right_value: str, tolerance: float = 0.005) -> DataFrame:
    """Compare two totals per key.  A key that one side lacks is an exception."""
    a = left.groupBy(*keys).agg(F.sum(left_value).alias("left_value"))
    b = right.groupBy(*keys).agg(F.sum(right_value).alias("right_value"))
    gap = F.abs(F.col("left_value") - F.col("right_value"))
    both = a.join(b, list(keys), "full")
    share = ratio(gap, F.abs("right_value"))
    return both.select(
        *keys, "left_value", "right_value",
        (F.col("left_value") - F.col("right_value")).alias("variance"),
        share.alias("variance_pct"),
        F.when(F.col("left_value").isNull() | F.col("right_value").isNull(), True)
        .when(F.col("right_value") == 0, F.col("left_value") != 0)
        .otherwise(share > tolerance).alias("is_exception"))


def daily_rates(rates: DataFrame, until: date | str) -> DataFrame:
    """Currency x day with the rate valid on the day, each rate holding until the next one."""
    line = Window.partitionBy("currency").orderBy("rate_date")
    spans = (rates.groupBy("currency", "rate_date").agg(F.max("rate").alias("rate"))
             .withColumn("_to", F.coalesce(F.date_sub(F.lead("rate_date").over(line), 1), day(until)))
             .filter(F.col("_to") >= F.col("rate_date")))
    return spans.select("currency", "rate",
                        F.explode(F.sequence("rate_date", "_to")).alias("valid_on"))


def normalize_fx(facts: DataFrame, rates: DataFrame, amount: str, on: str, until: date | str,
                 currency: str = "currency") -> DataFrame:
    """Add ``<amount>_usd``: the amount at the rate valid on its date, null without a rate.

    An as-of join as a plain equi-join on (currency, day): a dominant currency is spread
    over its days, and no pair of fact and rate is built only to be thrown away.
    """
    valid = daily_rates(rates, until).select(F.col("currency").alias(currency), F.col("valid_on").alias(on), "rate")
    joined = facts.join(valid, [currency, on], "left")
    return joined.select(*facts.columns, "rate",
                         (F.col(amount) * F.col("rate")).alias(f"{amount}_usd"))


def lock_period(published: DataFrame, recomputed: DataFrame, period: str, locked_until: date | str) -> DataFrame:
    """Published rows up to the lock, recomputed rows after it.

    Two disjoint filters on the period column, which prune partitions on either side.
    """
    kept = published.filter(F.col(period) <= day(locked_until))
    fresh = recomputed.filter(F.col(period) > day(locked_until))
    return kept.unionByName(fresh)


def revenue_per_head(margin: DataFrame, headcount: DataFrame) -> DataFrame:
    """Monthly revenue over monthly headcount (columns ``month`` and ``headcount``)."""
    heads = headcount.groupBy(F.col("month").alias("revenue_month")).agg(F.sum("headcount").alias("headcount"))
    return margin.join(heads, "revenue_month", "left").select(
        "revenue_month", "revenue_usd", "headcount",
        ratio(F.col("revenue_usd"), F.col("headcount")).alias("revenue_per_head_usd"))


def mean_growth(series: DataFrame, period: str = "revenue_month", value: str = "total_arr") -> DataFrame:
    """One row: the mean period-over-period growth, periods with a zero base skipped."""
    return growth_rate(series, period, value).agg(F.avg("growth").alias("mean_growth"))


def forecast_growth(series: DataFrame, generated_at: date | str, horizon: int = 12,
                    period: str = "revenue_month", value: str = "total_arr",
                    default_growth: float = 0.02) -> DataFrame:
    """Compound the mean growth from the last value; the default applies without any growth."""
    summary = growth_rate(series, period, value).agg(
        F.coalesce(F.avg("growth"), F.lit(default_growth)).alias("g"),
        F.max_by(F.col(value).cast("double"), F.col(period)).alias("last"))
    ahead = summary.filter(F.lit(horizon) > 0).select(
        "g", "last", F.explode(F.sequence(F.lit(1), F.lit(max(horizon, 1)))).alias("months_ahead"))
    return ahead.select("months_ahead",
                        (F.col("last") * F.pow(1 + F.col("g"), F.col("months_ahead"))).alias("forecast_arr_usd"),
                        F.lit("mean_growth").alias("forecast_method"),
                        instant(generated_at).alias("generated_at"))


def forecast_smoothing(series: DataFrame, generated_at: date | str, alpha: float = 0.3, horizon: int = 12,
                       period: str = "revenue_month", value: str = "total_arr",
                       by: Sequence[str] = ()) -> DataFrame:
    """Simple exponential smoothing in closed form: a weighted sum, flat ahead.

    level = sum of alpha (1-alpha)^(n-i) x_i for i > 1, plus (1-alpha)^(n-1) x_1.
    """
    line, all_rows = Window.partitionBy(*by).orderBy(period), Window.partitionBy(*by)
    numbered = (series.filter(F.col(value).isNotNull())
                .withColumn("_i", F.row_number().over(line)).withColumn("_n", F.count("*").over(all_rows)))
    weight = (F.when(F.col("_i") == 1, F.lit(1.0)).otherwise(F.lit(alpha))
              * F.pow(F.lit(1.0 - alpha), F.col("_n") - F.col("_i")))
    level = numbered.groupBy(*by).agg(F.sum(weight * F.col(value).cast("double")).alias("forecast_arr_usd"))
    ahead = level.filter((F.lit(horizon) > 0) & F.col("forecast_arr_usd").isNotNull())
    return ahead.select(*by, F.explode(F.sequence(F.lit(1), F.lit(max(horizon, 1)))).alias("months_ahead"),
                        "forecast_arr_usd", F.lit("exponential_smoothing").alias("forecast_method"),
                        instant(generated_at).alias("generated_at"))
