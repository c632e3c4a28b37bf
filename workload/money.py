"""Finance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import period_start
from tidemark.functions.values import attributed_revenue_proxy
from tidemark.operators import finance, people
from workload.bindings import AS_OF_ORDERS, SPINE_START
from workload.context import Registry

R = Registry()

R.add("account_customers", lambda c: finance.account_customers(c.marts.accounts, c.marts.customers), """
    select a.account_id, a.account_name, a.industry, a.account_type, k.customer_id as stripe_customer_id,
           a.created_at as account_created_at
    from s_account a left join s_customer k on k.salesforce_account_id = a.account_id""")
R.add("account_spine", lambda c: c.marts.account_spine, """
    select a.account_id, a.account_name, a.industry, a.account_type,
           (select customer_id from s_customer k where k.salesforce_account_id = a.account_id
            order by created_at, customer_id limit 1) as stripe_customer_id,
           (select count(*) from s_customer k where k.salesforce_account_id = a.account_id) as stripe_customer_count,
           a.created_at as account_created_at
    from s_account a""")
R.add("subscriptions_customers", lambda c: c.marts.subscriptions.join(c.marts.customers.select(
    "customer_id", "email", "salesforce_account_id"), "customer_id", "inner").select(
    "subscription_id", "customer_id", "email", "salesforce_account_id"), """
    select subscription_id, customer_id, c.email, salesforce_account_id
    from s_subscription join s_customer c using (customer_id)""")
R.add("customers_spine", lambda c: finance.customers_spine(c.marts.customers, c.marts.account_spine), """
    select customer_id, salesforce_account_id, account_name
    from s_customer left join s_account on account_id = salesforce_account_id""")
R.add("subscription_mrr", lambda c: c.marts.subscription_mrr, """
    select * replace (cast(annual_cents as bigint) as annual_cents),
           ((2 * annual_cents + 12) // 24) / 100.0 as mrr_usd from s_mrr""")
def _totals(c):
    return finance.arr_by_month(c.marts.subscription_mrr, c.marts.accounts, SPINE_START, AS_OF_ORDERS)


R.add("account_month_grid", lambda c: finance.account_month_grid(c.marts.accounts, SPINE_START, AS_OF_ORDERS),
      "select account_id, revenue_month from s_account cross join months")
R.add("interval_join", lambda c: finance.subscription_months(c.marts.subscription_mrr, SPINE_START, AS_OF_ORDERS), """
    select subscription_id, account_id, cast(annual_cents as bigint) as annual_cents, revenue_month
    from s_mrr join months
      on cast(revenue_month as timestamp) between date_trunc('month', period_start_at)
         and coalesce(canceled_at, period_end_at)""")
R.add("monthly_revenue", lambda c: c.marts.monthly_revenue,
      "select account_id, revenue_month, mrr_usd, arr_usd from m_revenue")
R.add("monthly_revenue_month_start", lambda c: finance.monthly_revenue(
    c.marts.subscription_mrr, c.marts.accounts, SPINE_START, AS_OF_ORDERS, rule="month_start",
    include_trials=False), """
    with t as (select a.account_id, d.revenue_month, cast(coalesce(sum(m.annual_cents), 0) as bigint) as cents
        from s_account a cross join months d
        left join s_mrr m on m.account_id = a.account_id and m.subscription_status <> 'trialing'
             and cast(d.revenue_month as timestamp) >= m.period_start_at
             and cast(d.revenue_month as timestamp) < coalesce(m.canceled_at, m.period_end_at)
        group by 1, 2)
    select account_id, revenue_month, ((2 * cents + 12) // 24) / 100.0 as mrr_usd, cents / 100.0 as arr_usd from t""")
R.add("total_arr_of_grid", lambda c: finance.total_arr(c.marts.monthly_revenue),
      "select revenue_month, sum(cents) / 100.0 as total_arr from m_revenue group by 1")
R.add("total_arr", _totals,
      "select revenue_month, sum(cents) / 100.0 as total_arr from m_revenue group by 1")
R.add("gross_margin", lambda c: c.marts.gross_margin, """
    select revenue_month, cast(revenue_usd as double) as revenue_usd, cast(cogs_usd as double) as cogs_usd,
           cast(revenue_usd - cogs_usd as double) as gross_profit_usd,
           cast(revenue_usd - cogs_usd as double) / nullif(cast(revenue_usd as double), 0) as gross_margin_pct
    from m_margin""")
R.add("revenue_cogs_join", lambda c: finance.gross_margin(c.raw["raw_transaction"]).select(
    "revenue_month", "revenue_usd", "cogs_usd"), """
    select r.m as revenue_month, cast(r.v as double) as revenue_usd, cast(coalesce(k.v, 0) as double) as cogs_usd
    from (select date_trunc('month', transaction_date)::date as m, sum(amount) as v from raw_transaction
          where account_type = 'Income' group by 1) r
    left join (select date_trunc('month', transaction_date)::date as m, sum(amount) as v from raw_transaction
          where account_type = 'COGS' group by 1) k on k.m = r.m""")
R.add("margin_by_segment", lambda c: finance.gross_margin(c.raw["raw_transaction"], ["product_line", "currency"]), """
    select revenue_month, product_line, currency, cast(sum(income) as double) as revenue_usd,
           cast(coalesce(sum(cost), 0) as double) as cogs_usd,
           cast(sum(income) - coalesce(sum(cost), 0) as double) as gross_profit_usd,
           cast(sum(income) - coalesce(sum(cost), 0) as double) / nullif(cast(sum(income) as double), 0)
               as gross_margin_pct
    from m_margin_parts group by 1, 2, 3 having count(income) > 0""")
R.add("margin_by_customer_segment", lambda c: finance.segment_margin(
    c.raw["raw_account_transaction"], c.marts.accounts, "industry", ["product_line"]), """
    with t as (select cast(date_trunc('month', transaction_date) as date) as revenue_month, industry as customer_segment, product_line,
                      case r.account_type when 'Income' then amount end as income, case r.account_type when 'COGS' then amount end as cost
               from raw_account_transaction r left join s_account s on s.account_id = r.account_id)
    select revenue_month, customer_segment, product_line, cast(sum(income) as double) as revenue_usd,
           cast(coalesce(sum(cost), 0) as double) as cogs_usd,
           cast(sum(income) - coalesce(sum(cost), 0) as double) as gross_profit_usd,
           cast(sum(income) - coalesce(sum(cost), 0) as double) / nullif(cast(sum(income) as double), 0)
               as gross_margin_pct
    from t group by 1, 2, 3 having count(income) > 0""")
R.add("net_revenue_retention", lambda c: finance.net_revenue_retention(c.marts.monthly_revenue), """
    with f as (select account_id, year(min(revenue_month)) as cohort_year from m_revenue where cents > 0 group by 1)
    select cast(f.cohort_year as integer) as cohort_year, cast(date_trunc('quarter', n.revenue_month) as date) as period,
           count(*) as base_accounts, sum(b.cents) / 100.0 as base_arr_usd, sum(n.cents) / 100.0 as current_arr_usd,
           (sum(n.cents) / 100.0) / (sum(b.cents) / 100.0) as nrr
    from m_revenue n join m_revenue b on b.account_id = n.account_id
         and n.revenue_month = b.revenue_month + interval 12 month
    join f on f.account_id = n.account_id
    where b.cents > 0 and month(n.revenue_month) in (3, 6, 9, 12) group by 1, 2""")
R.add("reconcile", lambda c: finance.reconcile(
    c.marts.monthly_revenue.withColumnRenamed("mrr_usd", "billed"),
    c.marts.gross_margin.select("revenue_month", F.col("revenue_usd").alias("booked")),
    ["revenue_month"], "billed", "booked"), """
    select coalesce(a.revenue_month, b.revenue_month) as revenue_month, a.cents / 100.0 as left_value,
           cast(b.revenue_usd as double) as right_value,
           cast(cast(a.cents / 100.0 as decimal(30,2)) - b.revenue_usd as double) as variance,
           cast(abs(cast(a.cents / 100.0 as decimal(30,2)) - b.revenue_usd) as double)
               / nullif(cast(abs(b.revenue_usd) as double), 0) as variance_pct,
           case when a.cents is null or b.revenue_usd is null then true
                when b.revenue_usd = 0 then a.cents <> 0
                else abs(a.cents / 100.0 - cast(b.revenue_usd as double)) / cast(abs(b.revenue_usd) as double) > 0.005
           end as is_exception
    from (select revenue_month, sum(mrr_cents) as cents from m_revenue group by 1) a
    full join m_margin b on a.revenue_month = b.revenue_month""")
R.add("normalize_fx", lambda c: finance.normalize_fx(
    c.raw["raw_transaction"].select("id", "transaction_date", "currency", "amount"), c.raw["raw_currency_rate"],
    "amount", "transaction_date", "2001-12-31"), """
    with r as (select currency, rate, rate_date as f, lead(rate_date) over (partition by currency order by rate_date)
               as t from raw_currency_rate)
    select x.id, x.transaction_date, x.currency, cast(x.amount as double) as amount, cast(r.rate as double) as rate,
           cast(x.amount * r.rate as double) as amount_usd
    from raw_transaction x left join r on r.currency = x.currency and x.transaction_date >= r.f
         and (r.t is null or x.transaction_date < r.t)""")
R.add("lock_period", lambda c: finance.lock_period(
    c.marts.gross_margin.select("revenue_month", "revenue_usd"),
    finance.gross_margin(c.raw["raw_transaction"].withColumn("amount", F.col("amount") * 2))
    .select("revenue_month", "revenue_usd"), "revenue_month", "1999-12-31"), """
    select revenue_month, cast(case when revenue_month <= date '1999-12-31' then revenue_usd
                                    else revenue_usd * 2 end as double) as revenue_usd from m_margin""")
R.add("revenue_per_head", lambda c: finance.revenue_per_head(c.marts.gross_margin, people.headcount_monthly(
    c.marts.workers, SPINE_START, AS_OF_ORDERS)), """
    select revenue_month, cast(revenue_usd as double) as revenue_usd, cast(h.n as bigint) as headcount,
           cast(revenue_usd as double) / nullif(cast(h.n as double), 0) as revenue_per_head_usd
    from m_margin left join (
        select m.revenue_month as month, count(w.employee_id) as n from months m
        left join s_worker w on w.hire_date <= last_day(m.revenue_month)
             and (w.termination_date is null or w.termination_date > last_day(m.revenue_month)) group by 1) h
      on h.month = revenue_month""")
R.add("attributed_revenue_proxy", lambda c: c.marts.funnel_metrics.select(
    "activity_month", attributed_revenue_proxy(F.col("marketing_spend_usd")).alias("attributed_revenue")),
    "select activity_month, cast(marketing_spend_usd * 3 as double) as attributed_revenue from m_funnel")
R.add("growth_rate", lambda c: finance.growth_rate(_totals(c), "revenue_month",
                                                   "total_arr"), """
    with t as (select revenue_month, sum(cents) / 100.0 as total_arr from m_revenue group by 1),
    g as (select *, lag(total_arr) over (order by revenue_month) as p from t)
    select revenue_month, total_arr, (total_arr - p) / nullif(p, 0) as growth from g""")
R.add("mean_growth", lambda c: finance.mean_growth(_totals(c)).select(
    F.round("mean_growth", 9).alias("mean_growth")), """
    with t as (select revenue_month, sum(cents) / 100.0 as total_arr from m_revenue group by 1),
    g as (select total_arr, lag(total_arr) over (order by revenue_month) as p from t)
    select round(avg((total_arr - p) / nullif(p, 0)), 9) as mean_growth from g""")
R.add("forecast_growth", lambda c: finance.forecast_growth(
    _totals(c), AS_OF_ORDERS).withColumn(
    "forecast_arr_usd", F.round("forecast_arr_usd", 0)), f"""
    with t as (select revenue_month, sum(cents) / 100.0 as total_arr from m_revenue group by 1),
    g as (select *, lag(total_arr) over (order by revenue_month) as p from t),
    s as (select coalesce(avg((total_arr - p) / nullif(p, 0)), 0.02) as g,
                 arg_max(total_arr, revenue_month) as last from g)
    select cast(i as integer) as months_ahead, round(last * power(1 + g, i), 0) as forecast_arr_usd,
           'mean_growth' as forecast_method, timestamp '{AS_OF_ORDERS}' as generated_at
    from s cross join range(1, 13) r(i)""")
R.add("forecast_smoothing", lambda c: finance.forecast_smoothing(
    _totals(c), AS_OF_ORDERS, 0.3, 6).withColumn(
    "forecast_arr_usd", F.round("forecast_arr_usd", 1)), f"""
    with t as (select row_number() over (order by revenue_month) as i, count(*) over () as n,
                      sum(cents) / 100.0 as x from m_revenue group by revenue_month)
    select cast(h as integer) as months_ahead,
           round(sum(case when i = 1 then 1.0 else 0.3 end * power(0.7, n - i) * x), 1) as forecast_arr_usd,
           'exponential_smoothing' as forecast_method, timestamp '{AS_OF_ORDERS}' as generated_at
    from t cross join range(1, 7) r(h) group by h""")
R.add("forecast_smoothing_by_owner", lambda c: finance.forecast_smoothing(
    c.raw["raw_opportunity"].groupBy("owner_id", F.trunc("close_date", "quarter").alias("q")).agg(
        F.sum("amount").alias("total")), AS_OF_ORDERS, 0.5, 2, "q", "total", ["owner_id"]).withColumn(
    "forecast_arr_usd", F.round("forecast_arr_usd", 1)), f"""
    with t as (select owner_id, cast(sum(amount) as double) as x,
                      row_number() over (partition by owner_id order by date_trunc('quarter', close_date)) as i,
                      count(*) over (partition by owner_id) as n
               from raw_opportunity group by owner_id, date_trunc('quarter', close_date))
    select owner_id, cast(h as integer) as months_ahead,
           round(sum(case when i = 1 then 1.0 else 0.5 end * power(0.5, n - i) * x), 1) as forecast_arr_usd,
           'exponential_smoothing' as forecast_method, timestamp '{AS_OF_ORDERS}' as generated_at
    from t cross join range(1, 3) r(h) group by owner_id, h""")
R.add("arr_by_month", lambda c: c.marts.revenue_kpis.groupBy(F.col("revenue_month").alias("period")).agg(
    F.sum("arr_usd").alias("arr")), "select revenue_month as period, sum(cents) / 100.0 as arr from m_revenue group by 1")
R.add("revenue_by_ledger_account", lambda c: c.raw["raw_transaction"].groupBy(
    period_start(F.col("transaction_date"), "month").alias("revenue_month"), "account_type").agg(
    F.sum("amount").alias("amount")), """
    select cast(date_trunc('month', transaction_date) as date) as revenue_month, account_type,
           cast(sum(amount) as double) as amount from raw_transaction group by 1, 2""")
