"""Metric layer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.values import ratio
from tidemark.plans import metrics
from workload.bindings import AS_OF_EVENTS, AS_OF_ORDERS, TEST_ACCOUNTS
from workload.context import EVENTS_FROM, Registry
from workload.oracle import FRAGMENTS

R = Registry()

# The semantic views once more, in SQL; test accounts are out wherever there is an account id.
FRAGMENTS.update({
    "v_revenue": "select account_id, revenue_month as t, mrr_cents, cents from m_revenue",
    "v_sales": f"select date '{AS_OF_ORDERS}' as t, * from s_real_opportunity where not is_closed",
    "v_win": """
        select cast(date_trunc('quarter', close_date) as date) as t, count(*) filter (where is_won) as won,
               count(*) as closed, cast(count(*) filter (where is_won) as double) / count(*) as win_rate
        from s_real_opportunity where is_closed group by 1""",
    "v_marketing": "select activity_month as t, mql_count, marketing_spend_usd as spend from m_funnel",
    "v_finance": "select revenue_month as t, revenue_usd as revenue, cogs_usd as cogs from m_margin",
    "v_product": """
        select activity_date as t, dau, sum(dau) over (order by activity_date rows 29 preceding) as mau
        from (select activity_date, sum(dau) as dau from m_real_engagement group by 1)""",
    "v_hr": """
        select snapshot_month as t, sum(headcount) as headcount, sum(terminations_last_month) as terminations
        from m_headcount group by 1""",
})

# metric -> (view, own grain, value)
SQL = {
    "arr": ("v_revenue", "month", "sum(cents) / 100.0"),
    "mrr": ("v_revenue", "month", "sum(mrr_cents) / 100.0"),
    "pipeline_value": ("v_sales", "day", "cast(sum(amount_usd) as double)"),
    "win_rate": ("v_win", "quarter", "avg(win_rate)"),
    "marketing_spend": ("v_marketing", "month", "cast(sum(spend) as double)"),
    "new_customers": ("v_marketing", "month", "cast(sum(mql_count) as double)"),
    "ad_spend": ("v_marketing", "month", "cast(sum(spend) as double)"),
    "attributed_revenue": ("v_marketing", "month", "cast(sum(spend * 3) as double)"),
    "cac": ("v_marketing", "month", "cast(sum(spend) as double) / nullif(sum(mql_count), 0)"),
    "roas": ("v_marketing", "month", "cast(sum(spend * 3) as double) / nullif(cast(sum(spend) as double), 0)"),
    "revenue": ("v_finance", "month", "cast(sum(revenue) as double)"),
    "cogs": ("v_finance", "month", "cast(sum(cogs) as double)"),
    "gross_margin_pct": ("v_finance", "month", "cast(sum(revenue) - sum(cogs) as double) "
                                               "/ nullif(cast(sum(revenue) as double), 0)"),
    "dau": ("v_product", "day", "cast(sum(dau) as double)"),
    "mau": ("v_product", "day", "cast(sum(mau) as double)"),
    "headcount": ("v_hr", "month", "cast(sum(headcount) as double)"),
    "terminations": ("v_hr", "month", "cast(sum(terminations) as double)"),
    "attrition_rate": ("v_hr", "month", "cast(sum(terminations) as double) / nullif(sum(headcount), 0)"),
}


def _sql(name: str, grain: str | None = None) -> str:
    view, own, value = SQL[name]
    grain = grain or own
    return (f"select '{name}' as metric, '{grain}' as grain, cast(date_trunc('{grain}', t) as date) as period, "
            f"{value} as value from {view} group by 3")


for _name in metrics.METRICS:
    R.add(f"metric_{_name}", lambda c, n=_name: metrics.metric(c.marts, n), _sql(_name))
for _name, _grain in (("arr", "quarter"), ("gross_margin_pct", "quarter"), ("dau", "week"), ("mau", "month"),
                      ("cac", "quarter"), ("attrition_rate", "quarter"), ("pipeline_value", "month"),
                      ("revenue", "year")):
    R.add(f"metric_{_name}_by_{_grain}", lambda c, n=_name, g=_grain: metrics.metric(c.marts, n, g),
          _sql(_name, _grain))
R.add("metric_pipeline_value_by_stage", lambda c: metrics.metric(c.marts, "pipeline_value", dims=["stage_name"]), """
    select 'pipeline_value' as metric, 'day' as grain, t as period, stage_name,
           cast(sum(amount_usd) as double) as value from v_sales group by 3, 4""")
R.add("metric_mrr_filtered", lambda c: metrics.metric(c.marts, "mrr", where=F.col("mrr_usd") >= 10000), """
    select 'mrr' as metric, 'month' as grain, t as period, sum(mrr_cents) / 100.0 as value
    from v_revenue where mrr_cents >= 1000000 group by 3""")
_USERS = f"""
    a as (select event_date as d, user_id from e_active where account_id not in {TEST_ACCOUNTS}),
    c as (select cast(g as date) as t from generate_series(timestamp '{EVENTS_FROM}', timestamp '{AS_OF_EVENTS}', interval 1 day) x(g)),
    u as (select t, (select count(distinct user_id) from a where d = t) as dau,
                 (select count(distinct user_id) from a where d between t - 29 and t) as mau from c)"""
R.add("metric_mau_corrected", lambda c: metrics.metric(c.marts, "mau", "month", corrected=True), f"""
    with {_USERS} select 'mau' as metric, 'month' as grain, date_trunc('month', t)::date as period,
           cast(arg_max(mau, t) as double) as value from u group by 3""")
R.add("metric_dau_corrected", lambda c: metrics.metric(c.marts, "dau", "month", corrected=True), f"""
    with {_USERS} select 'dau' as metric, 'month' as grain, date_trunc('month', t)::date as period,
           cast(sum(dau) as double) / count(*) as value from u group by 3""")
R.add("product_users", lambda c: c.marts.product_users, f"""
    with {_USERS} select t as activity_date, dau, mau from u""")
R.add("metric_arr_corrected", lambda c: metrics.metric(c.marts, "arr", "quarter", corrected=True), """
    with m as (select t, sum(cents) as cents from v_revenue group by 1)
    select 'arr' as metric, 'quarter' as grain, date_trunc('quarter', t)::date as period,
           arg_max(cents, t) / 100.0 as value from m group by 3""")
R.add("metric_win_rate_corrected", lambda c: metrics.win_rate_exact(c.marts, "year"), """
    select 'win_rate' as metric, 'year' as grain, date_trunc('year', t)::date as period,
           cast(sum(won) as double) / sum(closed) as value from v_win group by 3""")
_PER_ARR = metrics.Metric("pipeline_per_arr", "Open pipeline per recurring revenue", "sales", "ratio", ("pipeline_value", "arr"),
                          lambda v: ratio(v["pipeline_value"], v["arr"]))
R.add("metric_of_two_models", lambda c: metrics.metric(c.marts, _PER_ARR, "year", ["account_id"]), """
    with p as (select date_trunc('year', t)::date as period, account_id, sum(amount_usd) as pipeline from v_sales group by 1, 2),
    a as (select date_trunc('year', t)::date as period, account_id, sum(cents) as cents from v_revenue group by 1, 2)
    select 'pipeline_per_arr' as metric, 'year' as grain, coalesce(p.period, a.period) as period,
           coalesce(p.account_id, a.account_id) as account_id,
           cast(pipeline as double) / nullif(cast(cents / 100.0 as double), 0) as value
    from p full join a on p.period = a.period and p.account_id is not distinct from a.account_id""")
R.add("measures", lambda c: metrics.measures(c.marts, metrics.model_of("weighted_pipeline"),
                                             ["pipeline_value", "weighted_pipeline"], "day"), """
    select t as period, cast(sum(amount_usd) as double) as pipeline_value,
           cast(sum(amount_usd * probability_pct * cast(0.01 as decimal(3,2))) as double) as weighted_pipeline
    from v_sales group by 1""")
R.add("measure_avg_headcount", lambda c: metrics.measures(c.marts, metrics.model_of("avg_headcount"),
                                                          ["avg_headcount"], "month"),
      "select t as period, cast(avg(headcount) as double) as avg_headcount from v_hr group by 1")
_CALLER = ["product", "sales"]
_SERVED = " union all ".join(f"({_sql(n)})" for n in metrics.SERVED)
R.add("metric_query", lambda c: metrics.metric_query(c.marts), _SERVED)
R.add("scope_filter", lambda c: metrics.scope_filter(metrics.metric_query(c.marts, [
    n for n in metrics.SERVED if n in metrics.allowed_metrics(_CALLER)]), _CALLER),
      f"select * from ({_SERVED}) where metric in ('pipeline_value', 'win_rate', 'dau', 'mau')")
R.add("metric_metadata", lambda c: metrics.metric_metadata(
    metrics.metric_query(c.marts, ("win_rate", "arr")), "analyst", AS_OF_ORDERS), f"""
    select *, '1.0.0' as definition_version, timestamp '{AS_OF_ORDERS}' as generated_at, 'analyst' as requested_by,
           case metric when 'arr' then 'USD' end as currency from (({_sql('win_rate')}) union all ({_sql('arr')}))""")
R.add("metric_global_filter", lambda c: c.marts.sales_kpis.select("opportunity_id", "account_id"), f"""
    select opportunity_id, account_id from s_opportunity
    where not is_closed and account_id not in {TEST_ACCOUNTS}""")

# --- semantic projections
R.add("semantic_revenue_kpis", lambda c: c.marts.revenue_kpis,
      "select account_id, revenue_month, mrr_usd, arr_usd from m_revenue")
R.add("semantic_sales_kpis", lambda c: c.marts.sales_kpis, """
    select opportunity_id, account_id, t as snapshot_date, cast(amount_usd as double) as amount_usd,
           cast(amount_usd * probability_pct * cast(0.01 as decimal(3,2)) as double) as weighted_amount_usd, stage_name
    from v_sales""")
R.add("semantic_win_rate", lambda c: c.marts.sales_win_rate, "select t as fiscal_quarter, win_rate from v_win")
R.add("semantic_marketing_kpis", lambda c: c.marts.marketing_kpis, """
    select t as activity_month, cast(spend as double) as marketing_spend, mql_count as new_customers,
           cast(spend as double) as ad_spend, cast(spend * 3 as double) as attributed_revenue from v_marketing""")
R.add("semantic_finance_kpis", lambda c: c.marts.finance_kpis, """
    select t as activity_month, cast(revenue as double) as revenue, cast(cogs as double) as cogs,
           cast(revenue - cogs as double) / nullif(cast(revenue as double), 0) as gross_margin_pct from v_finance""")
R.add("semantic_product_kpis", lambda c: c.marts.product_kpis, """
    select t as activity_date, cast(dau as bigint) as dau, cast(mau as bigint) as mau,
           cast(dau as double) / nullif(mau, 0) as dau_mau_ratio from v_product""")
R.add("semantic_hr_kpis", lambda c: c.marts.hr_kpis.select("activity_month", "headcount", "terminations"), """
    select t as activity_month, cast(headcount as bigint) as headcount, cast(terminations as bigint) as terminations
    from v_hr""")
