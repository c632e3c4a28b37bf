"""Product usage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import day, period_start
from tidemark.operators import activity, chains, product, sketches
from tidemark.plans import incremental, metrics
from tidemark.session import checkpointed, work_dir
from tidemark.sources import landing
from workload.bindings import AS_OF_EVENTS
from workload.context import EVENTS_FROM, Registry

R = Registry()
SPAN = (EVENTS_FROM, AS_OF_EVENTS)


def _events(c):
    return c.raw["raw_event"]


def _by_account(c):
    return product.account_engagement(_events(c), *SPAN)


R.add("account_engagement", _by_account, "select * from m_engagement")
R.add("account_engagement_approx", lambda c: product.account_engagement_approx(_events(c), *SPAN).select(
    "activity_date", "account_id", "event_count", "features_used"),
    "select activity_date, account_id, event_count, features_used from m_engagement")
R.add("engagement_daily", lambda c: product.engagement_daily(_by_account(c)), """
    select activity_date, cast(sum(dau) as bigint) as dau, count(distinct account_id) as active_accounts
    from m_engagement group by 1""")
_DAILY = """
    d as (select activity_date, sum(dau) as dau, count(*) as active_accounts from m_engagement group by 1),
    r as (select *, sum(dau) over (order by activity_date rows 29 preceding) as mau from d)"""
R.add("rolling_sum", lambda c: product.rolling_sum(product.engagement_daily(_by_account(c)), "dau", "mau", 30), f"""
    with {_DAILY} select activity_date, cast(dau as bigint) as dau, active_accounts, cast(mau as bigint) as mau from r""")
R.add("daily_engagement", lambda c: product.daily_engagement(_by_account(c)), f"""
    with {_DAILY} select activity_date, cast(dau as bigint) as dau, active_accounts, cast(mau as bigint) as mau,
        cast(dau as double) / nullif(mau, 0) as dau_mau_ratio from r""")
R.add("stickiness", lambda c: product.daily_engagement(_by_account(c)).select("activity_date", "dau_mau_ratio"), f"""
    with {_DAILY} select activity_date, cast(dau as double) / nullif(mau, 0) as dau_mau_ratio from r""")
R.add("account_daily_engagement", lambda c: product.account_daily_engagement(_by_account(c)), """
    with r as (select *, sum(dau) over (partition by account_id order by activity_date rows 29 preceding) as mau
               from m_engagement)
    select account_id, activity_date, dau, cast(mau as bigint) as mau, event_count, sessions,
           cast(dau as double) / nullif(mau, 0) as dau_mau_ratio from r""")
R.add("rolling_distinct", lambda c: product.rolling_distinct(_events(c), *SPAN, n=7), f"""
    select cast(g as date) as activity_date, count(distinct e.user_id) as mau
    from generate_series(timestamp '{EVENTS_FROM}', timestamp '{AS_OF_EVENTS}', interval 1 day) t(g)
    left join raw_event e on e.event_date between cast(g as date) - 6 and cast(g as date) group by 1""")
R.add("rolling_distinct_by_account", lambda c: product.rolling_distinct(
    _events(c).filter(F.col("account_id").isNotNull()), *SPAN, n=30, by=["account_id"]), f"""
    select a.account_id, cast(g as date) as activity_date, count(distinct e.user_id) as mau
    from generate_series(timestamp '{EVENTS_FROM}', timestamp '{AS_OF_EVENTS}', interval 1 day) t(g)
    cross join (select distinct account_id from raw_event where account_id is not null) a
    left join raw_event e on e.account_id = a.account_id
         and e.event_date between cast(g as date) - 29 and cast(g as date) group by 1, 2""")
R.add("feature_adoption_daily", lambda c: product.feature_adoption_daily(_events(c), *SPAN), """
    select event_date as activity_date, event_name as feature_name, count(distinct user_id) as feature_users,
           count(distinct account_id) as accounts_using from raw_event group by 1, 2""")
R.add("feature_adoption_pct", lambda c: product.feature_adoption_pct(_events(c), *SPAN), """
    with u as (select distinct date_trunc('month', event_date)::date as m, event_name, user_id from e_active),
    t as (select m, count(distinct user_id) as mau from u group by 1)
    select u.m as activity_month, event_name as feature_name, count(*) as feature_users, t.mau,
           cast(count(*) as double) / t.mau as adoption_pct from u join t on t.m = u.m group by 1, 2, t.mau""")
R.add("feature_adoption_pct_by_account", lambda c: product.feature_adoption_pct(_events(c), *SPAN, by=["account_id"]), """
    with u as (select distinct date_trunc('month', event_date)::date as m, account_id, event_name, user_id
               from e_active),
    t as (select m, account_id, count(distinct user_id) as mau from u group by 1, 2)
    select u.m as activity_month, u.account_id, event_name as feature_name, count(*) as feature_users, t.mau,
           cast(count(*) as double) / t.mau as adoption_pct
    from u join t on t.m = u.m and t.account_id = u.account_id group by 1, 2, 3, t.mau""")
_SESSIONS = """
    o as (select *, lag(event_timestamp) over (partition by user_id order by event_timestamp) as p from raw_event),
    n as (select *, sum(case when p is null or event_timestamp - p > interval 30 minute then 1 else 0 end)
                    over (partition by user_id order by event_timestamp range unbounded preceding) as s from o)"""
R.add("sessionize", lambda c: product.sessionize(_events(c), *SPAN), f"""
    with {_SESSIONS} select user_id, cast(s as bigint) as session_number, min(event_timestamp) as session_start,
        max(event_timestamp) as session_end, count(*) as events from n group by 1, 2""")
R.add("session_ids", lambda c: product.session_ids(
    _events(c).select("event_id", "event_date", "user_id", "event_timestamp"), *SPAN), f"""
    with {_SESSIONS} select event_id, event_date, user_id, event_timestamp, cast(s as bigint) as session_number
    from n""")
R.add("event_funnel", lambda c: product.event_funnel(_events(c), *SPAN, steps=("view", "click", "purchase"),
                                                     within_hours=24), """
    with a as (select user_id, min(event_timestamp) as t1 from raw_event where event_name = 'view' group by 1),
    b as (select e.user_id, min(event_timestamp) as t2, min(t1) as t1 from raw_event e join a using (user_id)
          where event_name = 'click' and event_timestamp > t1 and event_timestamp <= t1 + interval 24 hour group by 1),
    c as (select e.user_id, min(event_timestamp) as t3 from raw_event e join b using (user_id)
          where event_name = 'purchase' and event_timestamp > t2 and event_timestamp <= t1 + interval 24 hour group by 1),
    u as (select 1 as step, 'view' as event_name, (select count(*) from a) as users
          union all select 2, 'click', (select count(*) from b) union all select 3, 'purchase', (select count(*) from c))
    select step, event_name, users,
           cast(users as double) / first_value(users) over (order by step) as conversion_from_start,
           cast(users as double) / coalesce(lag(users) over (order by step), users) as conversion_from_previous
    from u""")
R.add("retention", lambda c: product.retention(_events(c), *SPAN, grain="week"), """
    with s as (select distinct user_id, date_trunc('week', event_date)::date as p from raw_event),
    f as (select user_id, min(p) as cohort from s group by 1),
    k as (select cohort, (p - cohort) // 7 as k, count(*) as n from s join f using (user_id) group by 1, 2)
    select a.cohort, cast(a.k as bigint) as k, a.n as active_users, b.n as cohort_users,
           cast(a.n as double) / b.n as retention_rate
    from k a join k b on b.cohort = a.cohort and b.k = 0""")
R.add("retention_daily", lambda c: product.retention(_events(c), *SPAN, grain="day"), """
    with s as (select distinct user_id, event_date as p from raw_event),
    f as (select user_id, min(p) as cohort from s group by 1),
    k as (select cohort, p - cohort as k, count(*) as n from s join f using (user_id) group by 1, 2)
    select a.cohort, cast(a.k as bigint) as k, a.n as active_users, b.n as cohort_users,
           cast(a.n as double) / b.n as retention_rate
    from k a join k b on b.cohort = a.cohort and b.k = 0""")
R.add("activation_rate", lambda c: product.activation_rate(_events(c), *SPAN, signup="session_start",
                                                           activation="purchase", within_hours=24), """
    with s as (select user_id, min(event_timestamp) as t from raw_event where event_name = 'session_start' group by 1),
    a as (select distinct s.user_id from s join raw_event e on e.user_id = s.user_id and e.event_name = 'purchase'
          and e.event_timestamp between t and t + interval 24 hour)
    select date_trunc('week', t)::date as signup_week, count(*) as signups, count(a.user_id) as activated,
           cast(count(a.user_id) as double) / count(*) as activation_rate
    from s left join a on a.user_id = s.user_id group by 1""")
R.add("exclude_bots", lambda c: product.exclude_bots(
    _events(c), *SPAN, internal_users=c.raw["raw_event"].filter("account_id = '7'").select("user_id"),
    max_per_hour=2).select("event_id", "user_id"), """
    select event_id, user_id from raw_event
    where user_id not in (select user_id from raw_event group by user_id, date_trunc('hour', event_timestamp)
                          having count(*) > 2)
      and user_id not in (select user_id from raw_event where account_id = '7')""")
R.add("match_rate", lambda c: product.match_rate(_events(c), c.marts.accounts, *SPAN), """
    with l as (select e.account_id, a.account_id as known from raw_event e left join s_account a
               on a.account_id = e.account_id),
    t as (select count(*) as events, count(known) as matched, count(distinct account_id) as account_ids,
                 count(distinct known) as matched_ids from l)
    select *, cast(matched as double) / events as event_match_rate,
           cast(matched_ids as double) / account_ids as id_match_rate,
           cast(matched as double) / events >= 0.95 as meets_target from t""")
# Features of the scoring jobs; ARR of an account is its maximum over the months.
R.add("engagement_revenue_join", lambda c: product.account_daily_engagement(_by_account(c)).groupBy("account_id").agg(
    F.sum("dau").alias("dau"), F.max("activity_date").alias("last_active")).join(
    c.marts.monthly_revenue.groupBy("account_id").agg(F.max("arr_usd").alias("arr_usd")), "account_id", "left"), """
    select e.account_id, cast(sum(dau) as bigint) as dau, max(activity_date) as last_active,
           any_value(r.arr) as arr_usd
    from m_engagement e left join (select account_id, max(cents) / 100.0 as arr from m_revenue group by 1) r
         on r.account_id = e.account_id group by 1""")


def _bitmaps(c, events):
    """Bitmaps of two halves of the span, stored and merged, as two loads would leave them."""
    parts = [checkpointed(activity.activity_bitmaps(events, *span), "bitmaps")
             for span in ((EVENTS_FROM, "2024-01-12"), ("2024-01-13", AS_OF_EVENTS))]
    return activity.merge_bitmaps(*parts)


R.add("active_by_day", lambda c: activity.active_by_day(_bitmaps(c, product.not_in_events(_events(c))), *SPAN), f"""
    with d as (select event_date, count(distinct user_id) as dau from e_active group by 1),
    m as (select cast(g as date) as activity_date, count(distinct e.user_id) as mau
          from generate_series(timestamp '{EVENTS_FROM}', timestamp '{AS_OF_EVENTS}', interval 1 day) t(g)
          left join e_active e on e.event_date between cast(g as date) - 29 and cast(g as date) group by 1)
    select activity_date, coalesce(dau, 0) as dau, mau, cast(coalesce(dau, 0) as double) / nullif(mau, 0) as stickiness
    from m left join d on event_date = activity_date""")
R.alike("retention_of_bitmaps", lambda c: activity.retention_of(_bitmaps(c, _events(c)), "week"), "retention")
R.alike("retention_of_bitmaps_daily", lambda c: activity.retention_of(_bitmaps(c, _events(c)), "day"), "retention_daily")
R.alike("ordered_funnel", lambda c: chains.ordered_funnel(
    _events(c), *SPAN, steps=("view", "click", "purchase"), within_hours=24), "event_funnel")
R.alike("ordered_activation", lambda c: chains.ordered_activation(
    _events(c), *SPAN, signup="session_start", activation="purchase", within_hours=24), "activation_rate")


def _sketched(c, by_events):
    """Users by week and quarter and by the account's industry: exact ones, and whether stored sketches come within three
    standard errors of them."""
    parts = by_events(c)
    accounts = c.marts.accounts.select("account_id", "industry")
    events = product.not_in_events(_events(c)).join(accounts, "account_id", "left")
    result = None
    for grain in ("week", "quarter"):
        found = metrics.distinct_metric(parts, accounts, grain, ["industry"]).select(
            "metric", "grain", F.col("period").alias("_p"), F.col("industry").alias("_i"), "value", "approximate")
        exact = events.groupBy(period_start(F.col("event_date"), grain).alias("period"), "industry").agg(
            F.count_distinct("user_id").alias("users"))
        off = F.abs(F.col("value") - F.col("users")) / F.col("users")
        rows = exact.join(found, F.col("period").eqNullSafe(F.col("_p")) & F.col("industry").eqNullSafe(F.col("_i")), "full").select(
            "metric", "grain", "period", "industry", "users", "approximate",
            (off <= 3 * sketches.standard_error()).alias("within"))
        result = rows if result is None else result.unionByName(rows)
    return result


R.add("active_users_sketched", lambda c: _sketched(c, lambda c: checkpointed(
    sketches.distinct_parts(product.events_between(_events(c), *SPAN)), "sketches")), """
    with e as (select user_id, event_date, industry from e_active left join s_account using (account_id)),
    g as (select 'week' as grain, date_trunc('week', event_date)::date as period, industry, user_id from e
          union all select 'quarter', date_trunc('quarter', event_date)::date, industry, user_id from e)
    select 'active_users' as metric, grain, period, industry, count(distinct user_id) as users, true as approximate, true as within
    from g group by grain, period, industry""")


def _sketch_mart(c):
    """The mart of sketches after three loads, the last of them late and overlapping the others' days and users."""
    landed, mart = work_dir(c.spark, "landing"), work_dir(c.spark, "mart")
    late = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    first = F.col("event_date") <= day("2024-01-15")
    for load, rows in (("2024-01-15", first & ~late), ("2024-01-31", ~first & ~late), ("2024-02-05", late)):
        landing.land_partition(_events(c).filter(rows), landed, load, f"{load} 23:00:00")
        incremental.refresh(c.spark, landed, mart, incremental.ACTIVE_USERS, "month")
    return incremental.read_mart(c.spark, mart)


R.alike("active_users_sketched_loads", lambda c: _sketched(c, _sketch_mart), "active_users_sketched")
