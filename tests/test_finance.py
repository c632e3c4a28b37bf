from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import finance

SUB = ("subscription_id string, customer_id string, subscription_status string, plan_amount_usd decimal(18,2), "
       "plan_interval string, period_start_at timestamp_ntz, period_end_at timestamp_ntz, canceled_at timestamp_ntz, "
       "created_at timestamp_ntz")
ACC = "account_id string, account_name string, industry string, account_type string, created_at timestamp_ntz"
CUS = "customer_id string, email string, salesforce_account_id string, created_at timestamp_ntz"
T = datetime


def sub(i, customer, start, end, amount="100.00", interval="month", status="active", canceled=None):
    return (i, customer, status, Decimal(amount), interval, start, end, canceled, start)


@pytest.fixture
def frames(spark):
    accounts = spark.createDataFrame([("a", "A", "x", "t", T(2020, 1, 1)), ("b", "B", "x", "t", T(2020, 1, 1))], ACC)
    customers = spark.createDataFrame([
        ("c1", "e1", "a", T(2020, 1, 2)), ("c2", "e2", "a", T(2020, 1, 1)), ("c3", "e3", None, T(2020, 1, 1)),
        ("c4", "e4", "unknown", T(2020, 1, 1))], CUS)
    return accounts, customers


def revenue(spark, frames, subs, **options):
    accounts, customers = frames
    mrr = finance.subscription_mrr(spark.createDataFrame(subs, SUB), customers, accounts)
    return finance.monthly_revenue(mrr, accounts, "2021-01-01", "2021-06-15", **options)


def series(df, account="a"):
    return {r.revenue_month.month: r.mrr_usd for r in df.filter(F.col("account_id") == account).collect()}


def test_two_customers_of_an_account_count_once(spark, frames):
    subs = [sub("s1", "c1", T(2021, 1, 10), T(2021, 2, 9)), sub("s2", "c2", T(2021, 1, 10), T(2021, 2, 9))]
    assert series(revenue(spark, frames, subs))[1] == Decimal("200.00")
    assert finance.account_spine(*frames).count() == 2
    spine = {r.account_id: (r.stripe_customer_id, r.stripe_customer_count) for r in finance.account_spine(*frames).collect()}
    assert spine == {"a": ("c2", 2), "b": (None, 0)}
    assert finance.account_customers(*frames).count() == 3


def test_grid_is_complete_and_zero_without_subscriptions(spark, frames):
    df = revenue(spark, frames, [])
    assert df.count() == 12 and set(series(df).values()) == {Decimal("0.00")}


@pytest.mark.parametrize("start,end,canceled,months", [
    (T(2021, 1, 15), T(2021, 2, 15), None, [1, 2]),
    (T(2021, 1, 31), T(2021, 2, 28), None, [1, 2]),
    (T(2021, 1, 1), T(2021, 2, 1), None, [1, 2]),           # ends at midnight of the first
    (T(2021, 3, 10), T(2021, 4, 9), T(2021, 3, 10), [3]),   # canceled at the start
    (T(2021, 3, 10), T(2021, 4, 9), T(2021, 2, 1), []),     # canceled before the start
    (T(2020, 5, 1), T(2021, 2, 10), None, [1, 2]),          # begins before the calendar
    (T(2021, 5, 20), T(2022, 5, 20), None, [5, 6]),         # runs past the calendar
    (T(2022, 1, 1), T(2022, 2, 1), None, []),
    (T(2021, 1, 5), None, None, []),                        # no end at all
])
def test_months_covered(spark, frames, start, end, canceled, months):
    got = series(revenue(spark, frames, [sub("s", "c1", start, end, canceled=canceled)]))
    assert [m for m, v in sorted(got.items()) if v > 0] == months


def test_month_start_rule_is_half_open(spark, frames):
    subs = [sub("s", "c1", T(2021, 1, 15), T(2021, 3, 1)), sub("t", "c1", T(2021, 5, 1), T(2021, 5, 1, 0, 0, 1))]
    got = series(revenue(spark, frames, subs, rule="month_start"))
    assert [m for m, v in sorted(got.items()) if v > 0] == [2, 5]


def test_intervals_trials_and_statuses(spark, frames):
    at = (T(2021, 1, 1), T(2021, 1, 20))
    subs = [sub("y", "c1", *at, amount="100.00", interval="year"), sub("w", "c1", *at, interval="week"),
            sub("t", "c1", *at, amount="7.00", status="trialing"), sub("x", "c1", *at, status="canceled"),
            sub("n", "c3", *at), sub("u", "c4", *at), sub("z", "gone", *at)]
    df = revenue(spark, frames, subs)
    assert series(df)[1] == Decimal("15.33")
    arr = df.filter("account_id = 'a' and revenue_month = date '2021-01-01'").first().arr_usd
    assert arr == Decimal("184.00")  # 12 x 7 + 100: not twelve times the rounded month
    assert series(revenue(spark, frames, subs, include_trials=False))[1] == Decimal("8.33")
    accounts, customers = frames
    mrr = finance.subscription_mrr(spark.createDataFrame(subs, SUB), customers, accounts)
    assert {r.subscription_id: r.account_id for r in mrr.collect()} == {
        "y": "a", "w": "a", "t": "a", "n": None, "u": None}


def test_explode_and_sweep_agree(spark, frames):
    subs = [sub(f"s{i}", "c1", T(2021, 1 + i % 5, 1 + i), T(2021, 2 + i % 5, 3), amount=f"{10 + i}.37") for i in range(20)]
    accounts, customers = frames
    mrr = finance.subscription_mrr(spark.createDataFrame(subs, SUB), customers, accounts)
    long = finance.subscription_months(mrr, "2021-01-01", "2021-06-15").groupBy("revenue_month").agg(
        F.sum("annual_cents").alias("c")).collect()
    arr = {r.revenue_month: r.arr_usd for r in revenue(spark, frames, subs).filter("account_id='a'").collect()}
    assert {r.revenue_month: Decimal(r.c) / 100 for r in long} == {k: v for k, v in arr.items() if v > 0}


def test_margin_zero_revenue_and_cost_only_months(spark):
    df = spark.createDataFrame([
        (date(2021, 1, 1), "Income", Decimal("10.00")), (date(2021, 1, 2), "Income", Decimal("-10.00")),
        (date(2021, 1, 3), "COGS", Decimal("4.00")), (date(2021, 2, 3), "COGS", Decimal("4.00")),
        (date(2021, 3, 3), "Income", Decimal("8.00")), (date(2021, 4, 3), "Other", Decimal("8.00"))],
        "transaction_date date, account_type string, amount decimal(18,2)")
    got = {r.revenue_month.month: (r.cogs_usd, r.gross_margin_pct) for r in finance.gross_margin(df).collect()}
    assert got == {1: (Decimal("4.00"), None), 3: (Decimal("0.00"), 1.0)}


def test_forecast_edges(spark, rows):
    schema = "revenue_month date, total_arr decimal(18,2)"
    one = spark.createDataFrame([(date(2021, 1, 1), Decimal("100"))], schema)
    got = rows(finance.forecast_growth(one, "2021-02-01", 2), "months_ahead", "forecast_arr_usd")
    assert got[0] == (1, pytest.approx(102.0)) and got[1] == (2, pytest.approx(104.04))
    flat = spark.createDataFrame([(date(2021, m, 1), Decimal("100")) for m in (1, 2, 3)], schema)
    assert rows(finance.forecast_growth(flat, "2021-04-01", 1), "forecast_arr_usd") == [(100.0,)]
    zero = spark.createDataFrame([(date(2021, 1, 1), Decimal("0")), (date(2021, 2, 1), Decimal("50")),
                                  (date(2021, 3, 1), Decimal("100"))], schema)
    assert rows(finance.forecast_growth(zero, "2021-04-01", 1), "forecast_arr_usd") == [(200.0,)]
    assert finance.forecast_growth(flat, "2021-04-01", 0).count() == 0
    assert rows(finance.forecast_smoothing(zero, "2021-04-01", 0.5, 1), "forecast_arr_usd") == [(62.5,)]
    assert finance.forecast_smoothing(zero.limit(0), "2021-04-01").count() == 0


def test_fx_before_first_rate_and_reconcile_gaps(spark, rows):
    facts = spark.createDataFrame([("x", date(2021, 1, 1), "EUR", Decimal("10")), ("y", date(2021, 1, 20), "EUR", Decimal("10")),
                                   ("z", date(2021, 2, 1), "EUR", Decimal("10"))],
                                  "id string, d date, currency string, amount decimal(18,2)")
    rates = spark.createDataFrame([("EUR", date(2021, 1, 10), Decimal("1.1")), ("EUR", date(2021, 2, 1), Decimal("1.2"))],
                                  "currency string, rate_date date, rate decimal(9,4)")
    got = rows(finance.normalize_fx(facts, rates, "amount", "d", "2021-12-31"), "id", "amount_usd")
    assert [(i, v and float(v)) for i, v in got] == [("x", None), ("y", 11.0), ("z", 12.0)]
    a = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, 5.0), (5, 0.0)], "k int, v double")
    b = spark.createDataFrame([(1, 100.4), (2, 110.0), (4, 5.0), (5, 0.0)], "k int, w double")
    assert rows(finance.reconcile(a, b, ["k"], "v", "w"), "k", "is_exception") == [
        (1, False), (2, True), (3, True), (4, True), (5, False)]


def test_filled_in_months_are_spread(spark):
    """Few changes make many rows: they arise in many parts, however little was shuffled, and are grouped there."""
    accounts = spark.range(3000).select(F.col("id").cast("string").alias("account_id"))
    mrr = accounts.limit(50).select(
        "account_id", F.lit(1200).cast("bigint").alias("annual_cents"), F.lit("active").alias("subscription_status"),
        F.lit("1995-03-01").cast("timestamp_ntz").alias("period_start_at"),
        F.lit("1996-03-01").cast("timestamp_ntz").alias("period_end_at"), F.lit(None).cast("timestamp_ntz").alias("canceled_at"))
    revenue = finance.monthly_revenue(mrr, accounts, "1995-01-01", "2001-08-01")
    sizes = [r["count"] for r in revenue.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 * 80 and len(sizes) > 200 and max(sizes) < 3000 * 80 / 50
    assert revenue.groupBy("account_id", "revenue_month").count().filter("count > 1").count() == 0
