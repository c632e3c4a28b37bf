"""Empty input everywhere, and properties that must hold for any input."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st

from tidemark.operators import finance, history, identity, marketing, people, product, quality, sales
from tidemark.sources import registry
from workload.bindings import TABLES

SPAN = ("2024-01-01", "2024-01-05")
EVENT = registry.EVENT_SCHEMA


@pytest.fixture(scope="module")
def empty(spark):
    return lambda schema: spark.createDataFrame([], schema)


OPP = ("opportunity_id string, account_id string, stage_name string, amount_usd decimal(18,2), "
       "probability_pct decimal(5,2), is_closed boolean, is_won boolean, close_date date, created_at timestamp_ntz, "
       "owner_id string, opportunity_type string, lead_created_at timestamp_ntz")
ACC = ("account_id string, account_name string, industry string, account_type string, billing_country string, "
       "created_at timestamp_ntz")
CUS = "customer_id string, email string, salesforce_account_id string, created_at timestamp_ntz"
TOUCH = "touch_id string, opportunity_id string, touched_at timestamp_ntz"
HIST = "opportunity_id string, version int, stage_name string, amount decimal(18,2), changed_at timestamp"
SCD = "k string, stage string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"

CASES = {
    "account_engagement": lambda e: product.account_engagement(e(EVENT), *SPAN),
    "daily_engagement": lambda e: product.daily_engagement(product.account_engagement(e(EVENT), *SPAN)),
    "feature_adoption_daily": lambda e: product.feature_adoption_daily(e(EVENT), *SPAN),
    "feature_adoption_pct": lambda e: product.feature_adoption_pct(e(EVENT), *SPAN),
    "sessionize": lambda e: product.sessionize(e(EVENT), *SPAN),
    "session_ids": lambda e: product.session_ids(e(EVENT), *SPAN),
    "retention": lambda e: product.retention(e(EVENT), *SPAN),
    "activation_rate": lambda e: product.activation_rate(e(EVENT), *SPAN, signup="a", activation="b"),
    "exclude_bots": lambda e: product.exclude_bots(e(EVENT), *SPAN, internal_users=e("user_id string"), max_per_hour=1),
    "account_customers": lambda e: finance.account_customers(e(ACC), e(CUS)),
    "account_spine": lambda e: finance.account_spine(e(ACC), e(CUS)),
    "gross_margin": lambda e: finance.gross_margin(e("transaction_date date, account_type string, amount decimal(18,2)")),
    "pipeline_snapshot": lambda e: sales.pipeline_snapshot(e(OPP), "2024-01-01"),
    "win_rate": lambda e: sales.win_rate(e(OPP)),
    "sales_cycle": lambda e: sales.sales_cycle(e(OPP)),
    "stage_conversion": lambda e: sales.stage_conversion(e(HIST)),
    "attribution_w": lambda e: marketing.attribution_w(e(TOUCH), e(OPP)),
    "headcount_monthly": lambda e: people.headcount_monthly(
        e("department string, hire_date date, termination_date date"), *SPAN),
    "scd2_from_history": lambda e: history.scd2_from_history(e(HIST), "opportunity_id", "changed_at", ["stage_name"]),
    "scd2_merge": lambda e: history.scd2_merge(
        e("k string, stage string, t timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"),
        e("k string, stage string, t timestamp_ntz"), "k", "t", "2024-01-01"),
    "as_of_lookup": lambda e: history.as_of_lookup(e("k string, at timestamp_ntz"), e(SCD), "k", "at", ["stage"]),
    "snapshot_totals": lambda e: history.snapshot_totals(e(SCD), *SPAN, by=["stage"], measures=[]),
    "identity_links": lambda e: identity.identity_links(e(ACC), e(CUS), e("contact_id string, email string"), e(EVENT), *SPAN),
    "row_count_anomaly": lambda e: quality.row_count_anomaly(e(EVENT), "event_date"),
}


@pytest.mark.parametrize("name", CASES)
def test_empty_input_gives_an_empty_result(empty, name):
    df = CASES[name](empty)
    assert df.columns and df.collect() == []


def test_empty_input_of_operators_that_always_answer(empty):
    assert product.event_funnel(empty(EVENT), *SPAN, steps=("a", "b")).select("users").collect() == [(0,), (0,)]
    assert {r.mau for r in product.rolling_distinct(empty(EVENT), *SPAN).collect()} == {0}
    assert finance.mean_growth(empty("revenue_month date, total_arr decimal(18,2)")).collect() == [(None,)]
    assert product.match_rate(empty(EVENT), empty("account_id string"), *SPAN).first().event_match_rate is None
    assert empty(TABLES["events"]).count() == 0


def test_attribution_weights_sum_to_one(spark):
    r = random.Random(11)
    t0 = datetime(2024, 1, 1)
    opps = [(f"o{i}", t0 + timedelta(days=r.randrange(20)), t0 + timedelta(days=r.randrange(20))) for i in range(40)]
    touches = [(f"t{i}", "o0" if i % 3 == 0 else f"o{r.randrange(45)}", t0 + timedelta(days=r.randrange(25)))
               for i in range(400)]
    got = marketing.attribution_w(spark.createDataFrame(touches, TOUCH), spark.createDataFrame(
        opps, "opportunity_id string, lead_created_at timestamp_ntz, created_at timestamp_ntz")).collect()
    totals = defaultdict(float)
    for row in got:
        assert 0 < row.weight <= 1
        totals[row.opportunity_id] += row.weight
    assert totals and all(abs(v - 1) < 1e-9 for v in totals.values())
    first = {o: min((t, i) for i, oo, t in touches if oo == o)[1] for o in totals}
    by_touch = {row.touch_id: row.weight for row in got}
    for o, touch in first.items():
        others = [w for row in got if row.opportunity_id == o for w in [row.weight]]
        assert by_touch[touch] >= min(others)


def test_sketched_rolling_users_are_close(spark):
    rows = [(f"u{i % 700}", datetime(2024, 1, 1) + timedelta(hours=i % 100)) for i in range(5000)]
    df = spark.createDataFrame([(u, t, t.date()) for u, t in rows], "user_id string, event_timestamp timestamp_ntz, event_date date")
    exact = {r.activity_date: r.mau for r in product.rolling_distinct(df, *SPAN, n=3).collect()}
    near = {r.activity_date: r.mau for r in product.rolling_distinct_approx(df, *SPAN, n=3).collect()}
    assert exact.keys() == near.keys() and all(abs(near[d] - exact[d]) <= 0.05 * exact[d] for d in exact)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 200)), min_size=1, max_size=40))
def test_sessions_partition_the_events(spark, stamps):
    t0 = datetime(2024, 1, 1)
    rows = [(str(i), u, t0 + timedelta(minutes=10 * m), (t0 + timedelta(minutes=10 * m)).date())
            for i, (u, m) in enumerate(stamps)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_timestamp timestamp_ntz, event_date date")
    got = product.sessionize(df, *SPAN).collect()
    assert sum(r.events for r in got) == sum(u is not None for u, _ in stamps)
    for user in ("a", "b"):
        own = sorted((r.session_start, r.session_end) for r in got if r.user_id == user)
        for (_, end), (start, _) in zip(own, own[1:]):
            assert start - end > timedelta(minutes=30)
