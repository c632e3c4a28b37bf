"""Staging, calendars and the shared projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import values
from tidemark.functions.dates import to_utc
from tidemark.operators import calendar, relational, staging
from tidemark.operators.product import engagement_daily, events_between
from workload.bindings import AS_OF_EVENTS, AS_OF_ORDERS, SPINE_START, TEST_ACCOUNTS
from workload.context import EVENTS_FROM, Registry

R = Registry()

# --- staging projections
R.add("stg_accounts", lambda c: staging.stg_accounts(c.raw["raw_account"], TEST_ACCOUNTS), """
    select account_id, account_name, industry, account_type, cast(annual_revenue as double) as annual_revenue,
           number_of_employees, billing_country, created_at, updated_at, is_deleted, loaded_at from s_account""")
R.add("dim_accounts", lambda c: staging.dim_accounts(c.marts.accounts), """
    select account_id, account_name, industry, account_type, cast(annual_revenue as double) as annual_revenue,
           number_of_employees, billing_country, created_at, updated_at, is_deleted, loaded_at from s_account""")
R.add("stg_opportunities", lambda c: staging.stg_opportunities(c.raw["raw_opportunity"]), """
    select * replace (cast(amount_usd as double) as amount_usd, cast(probability_pct as double) as probability_pct)
    from s_opportunity""")
R.add("stg_customers", lambda c: staging.stg_customers(c.raw["raw_billing_customer"]), "select * from s_customer")
R.add("stg_subscriptions", lambda c: staging.stg_subscriptions(c.raw["raw_subscription"]),
      "select * exclude (cents) from s_subscription")
R.add("stg_contacts", lambda c: staging.stg_contacts(c.raw["raw_contact"]), "select * from s_contact")
R.add("stg_workers", lambda c: staging.stg_workers(c.raw["raw_worker"]),
      "select * replace (cast(fte as double) as fte) from s_worker")

# --- generic projections and filters
R.add("rename_cast", lambda c: relational.rename_cast(c.base("part"), {
    "part_id": ("p_partkey", "string"), "brand": "p_brand", "size_units": ("p_size", "bigint"),
    "list_price": ("p_retailprice", "decimal(12,2)")}), """
    select cast(p_partkey as varchar) as part_id, p_brand as brand, cast(p_size as bigint) as size_units,
           cast(cast(p_retailprice as decimal(12,2)) as double) as list_price from part""")
R.add("cents_to_dollars", lambda c: c.raw["raw_subscription"].select(
    "id", values.cents_to_dollars(F.col("plan_amount")).alias("plan_amount_usd")),
    "select id, plan_amount / 100.0 as plan_amount_usd from raw_subscription")
R.add("drop_soft_deleted", lambda c: relational.drop_soft_deleted(c.raw["raw_account"]).select("id", "is_deleted"),
      "select id, is_deleted from raw_account where is_deleted is null or not is_deleted")
R.add("exclude_ids", lambda c: relational.exclude_ids(
    c.raw["raw_event"].select("event_id", "account_id"), "account_id", TEST_ACCOUNTS),
    f"select event_id, account_id from raw_event where account_id not in {TEST_ACCOUNTS}")
R.add("exclude_ids_table", lambda c: relational.exclude_ids(
    c.raw["raw_event"].select("event_id", "account_id"), "account_id",
    c.raw["raw_account"].filter("is_deleted").select("id")), """
    select event_id, account_id from raw_event
    where account_id is not null and account_id not in (select id from raw_account where is_deleted)""")
_WITH_NULL = [None, *TEST_ACCOUNTS]
_LONG = [*_WITH_NULL, *[f"nobody-{n}" for n in range(300)]]
for _name, _ids in (("exclude_ids_null_listed", _WITH_NULL), ("exclude_ids_long_null_listed", _LONG), ("exclude_ids_none", [])):
    R.add(_name, lambda c, ids=_ids: relational.exclude_ids(
        c.raw["raw_event"].select("event_id", "account_id"), "account_id", ids),
        f"select event_id, account_id from raw_event where account_id is not null"
        + (f" and account_id not in {TEST_ACCOUNTS}" if _ids else ""))
R.add("surrogate_key", lambda c: c.raw["raw_worker"].select(
    "worker_id", values.surrogate_key(["worker_id", "department", "manager_id", "fte"]).alias("row_key")), """
    select worker_id, md5(worker_id || '-' || coalesce(department, '_null_') || '-' ||
           coalesce(manager_id, '_null_') || '-' || coalesce(cast(fte as varchar), '_null_')) as row_key
    from raw_worker""")
R.add("json_field", lambda c: c.raw["raw_event"].select(
    "event_id", values.json_field(F.col("event_params"), "$.k", "bigint").alias("k")),
    "select event_id, cast(json_extract_string(event_params, '$.k') as bigint) as k from raw_event")
R.add("status_in", lambda c: relational.status_in(
    staging.stg_subscriptions(c.raw["raw_subscription"]), "subscription_status",
    ("active", "trialing", "past_due")).select("subscription_id", "subscription_status"), """
    select subscription_id, subscription_status from s_subscription
    where subscription_status in ('active', 'trialing', 'past_due')""")
R.add("lookback", lambda c: relational.lookback(c.raw["raw_event"], "event_date", 10, AS_OF_EVENTS)
      .select("event_id", "event_date"), f"""
    select event_id, event_date from raw_event
    where event_date between date '{AS_OF_EVENTS}' - 10 and date '{AS_OF_EVENTS}'""")
R.add("not_in_events", lambda c: relational.not_in_events(c.raw["raw_event"])
      .select("event_id", "event_name", "account_id"), "select event_id, event_name, account_id from e_active")
R.add("to_utc", lambda c: c.raw["raw_event"].select(
    "event_id", to_utc(F.col("event_timestamp"), "America/New_York").alias("event_utc")), """
    select event_id, (event_timestamp at time zone 'America/New_York') at time zone 'UTC' as event_utc
    from raw_event""")
R.add("incremental_since", lambda c: relational.incremental_since(
    c.raw["raw_opportunity"], "close_date", "2001-01-01").select("id", "close_date"),
    "select id, close_date from raw_opportunity where close_date >= date '2001-01-01'")

# --- sorts and limits
R.add("ordered_series", lambda c: c.marts.sales_win_rate.orderBy("fiscal_quarter"), """
    select cast(date_trunc('quarter', close_date) as date) as fiscal_quarter,
           cast(count(*) filter (where is_won) as double) / count(*) as win_rate
    from s_real_opportunity where is_closed group by 1 order by 1""")
R.add("latest_row", lambda c: relational.latest_value(
    engagement_daily(c.marts.account_engagement), "dau", "activity_date"), """
    select activity_date, cast(sum(dau) as bigint) as dau from m_real_engagement
    group by 1 order by 1 desc limit 1""")
R.add("last_of_series", lambda c: relational.latest_value(
    c.marts.monthly_revenue.groupBy("revenue_month").agg(F.sum("arr_usd").alias("arr_usd")),
    "arr_usd", "revenue_month"), """
    select revenue_month, sum(cents) / 100.0 as arr_usd from m_revenue group by 1 order by 1 desc limit 1""")
R.add("list_limits", lambda c: relational.top_k(c.raw["raw_access_history"].select("query_id", "user_name"), 10,
                                                F.col("query_id")),
      "select query_id, user_name from raw_access_history order by query_id limit 10")
R.add("top_k", lambda c: relational.top_k(
    c.raw["raw_ad_spend"].groupBy("campaign_id").agg(F.sum("spend_usd").alias("spend_usd")), 20,
    F.desc("spend_usd"), F.col("campaign_id")), """
    select campaign_id, cast(sum(spend_usd) as double) as spend_usd from raw_ad_spend
    group by 1 order by sum(spend_usd) desc, campaign_id limit 20""")

# --- windows over keys
R.add("latest_by_key", lambda c: relational.latest_by_key(
    c.raw["raw_opportunity_history"], ["opportunity_id"], ["changed_at", "version", "stage_name", "amount"]), """
    select opportunity_id, version, stage_name, cast(amount as double) as amount, changed_at
    from (select *, row_number() over (partition by opportunity_id
                 order by changed_at desc, version desc, stage_name desc, amount desc) as rn
          from raw_opportunity_history) where rn = 1""")

# --- calendars: spans come from the data they serve
def _event_days(c):
    return engagement_daily(c.marts.account_engagement)


R.add("dim_date_2030", lambda c: calendar.dim_date(c.spark, "2030-01-01", SPINE_START).join(
    c.raw["raw_opportunity"].select(F.col("close_date").alias("date_day")).distinct(), "date_day", "left_semi")
    .select("date_day", "fiscal_year").unionByName(
        calendar.dim_date(c.spark, "2030-01-01", SPINE_START).agg(F.max("date_day").alias("date_day"),
                                                                  F.max("fiscal_year").alias("fiscal_year"))), """
    select distinct close_date as date_day, cast(year(close_date) as integer) as fiscal_year from raw_opportunity
    where close_date between date '1995-01-01' and date '2032-01-01'
    union all select date '2032-01-01', 2032""")
R.add("dim_date", lambda c: calendar.dim_date(c.spark, AS_OF_ORDERS, SPINE_START, fiscal_start=7).join(
    c.raw["raw_opportunity"].groupBy(F.col("close_date").alias("date_day")).agg(F.count("*").alias("closings")),
    "date_day", "left"), f"""
    with d as (select cast(g as date) as date_day from generate_series(timestamp '{SPINE_START}',
                 timestamp '{AS_OF_ORDERS}' + interval 24 month,
                 interval 1 day) t(g)),
    n as (select close_date, count(*) as closings from raw_opportunity group by 1)
    select date_day, cast(date_trunc('month', date_day) as date) as month_start,
           cast(date_trunc('quarter', date_day) as date) as quarter_start,
           cast(case when month(date_day) >= 7 then year(date_day) + 1 else year(date_day) end as integer)
               as fiscal_year,
           cast(case when month(date_day) >= 7 then (month(date_day) - 7) // 3 + 1
                     else (month(date_day) + 5) // 3 + 1 end as integer) as fiscal_quarter,
           month(date_day) = 6 and day(date_day) = 30 as is_fiscal_year_end, n.closings
    from d left join n on n.close_date = d.date_day""")
R.add("time_spine", lambda c: calendar.time_spine(c.spark, "1995-01-01", "2002-01-01").join(
    c.raw["raw_transaction"].groupBy(F.col("transaction_date").alias("date_day")).agg(
        F.count("*").alias("transactions")), "date_day", "left"), """
    select date_day, transactions from (select cast(g as date) as date_day from
        generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day) t(g))
    left join (select transaction_date, count(*) as transactions from raw_transaction group by 1)
        on transaction_date = date_day""")
R.add("month_spine", lambda c: calendar.month_spine(c.spark, SPINE_START, AS_OF_ORDERS).join(
    c.raw["raw_transaction"].groupBy(F.trunc("transaction_date", "month").alias("revenue_month")).agg(
        F.count("*").alias("transactions")), "revenue_month", "left"), """
    select revenue_month, transactions from months
    left join (select cast(date_trunc('month', transaction_date) as date) as m, count(*) as transactions
               from raw_transaction group by 1) on m = revenue_month""")
R.add("date_range", lambda c: calendar.date_range(c.spark, EVENTS_FROM, AS_OF_EVENTS).join(
    events_between(c.raw["raw_event"], EVENTS_FROM, AS_OF_EVENTS).groupBy(
        F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("events")), "day", "left"), f"""
    select day, events from (select strftime(g, '%Y-%m-%d') as day from
        generate_series(timestamp '{EVENTS_FROM}', timestamp '{AS_OF_EVENTS}', interval 1 day) t(g))
    left join (select strftime(event_date, '%Y-%m-%d') as d, count(*) as events from raw_event group by 1)
        on d = day""")
R.add("fill_gaps", lambda c: calendar.fill_gaps(
    _event_days(c), calendar.spine(c.spark, "2023-12-25", "2024-02-05", "day", "activity_date"),
    "activity_date", ["dau", "active_accounts"]), """
    select cast(g as date) as activity_date, cast(coalesce(dau, 0) as bigint) as dau,
           cast(coalesce(accounts, 0) as bigint) as active_accounts
    from generate_series(timestamp '2023-12-25', timestamp '2024-02-05', interval 1 day) t(g)
    left join (select activity_date as d, sum(dau) as dau, count(*) as accounts from m_real_engagement group by 1)
        on d = cast(g as date)""")
