"""Sales and marketing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.operators import marketing, sales, sketches
from workload.bindings import AS_OF_ORDERS
from workload.context import AS_DEFINED, Registry
from workload.ranks import ranked
from tidemark.plans.contracts import CAMPAIGNS, contract_check
from tidemark.plans.marts import Marts

R = Registry()


def _opps(c):
    """Opportunities as the staging operator defines them, test accounts included."""
    return Marts(c.raw, AS_DEFINED).opportunities


R.add("open_pipeline_filter", lambda c: sales.open_pipeline_filter(_opps(c)).select("opportunity_id", "is_closed"),
      "select opportunity_id, is_closed from s_opportunity where not is_closed")
R.add("pipeline_snapshot", lambda c: sales.pipeline_snapshot(_opps(c), AS_OF_ORDERS), f"""
    select date '{AS_OF_ORDERS}' as snapshot_date, opportunity_id, account_id, stage_name,
           cast(amount_usd as double) as amount_usd, cast(probability_pct as double) as probability_pct,
           cast(amount_usd * probability_pct * cast(0.01 as decimal(3,2)) as double) as weighted_amount_usd,
           is_closed, is_won, close_date, owner_id
    from s_opportunity where not is_closed""")
R.add("win_rate", lambda c: sales.win_rate(_opps(c)), """
    select fiscal_quarter, won_count, lost_count, closed_count, cast(won_amount_usd as double) as won_amount_usd,
           cast(won_count as double) / nullif(closed_count, 0) as win_rate,
           cast(won_amount_usd as double) / nullif(won_count, 0) as avg_deal_size_usd from m_win""")
R.add("win_rate_cube", lambda c: sales.win_rate_cube(_opps(c), c.marts.accounts), """
    select segment, region, product_line, fiscal_quarter,
           cast(grouping_id(segment, region, product_line, fiscal_quarter) as bigint) as grouping_level,
           count(*) filter (where is_won) as won_count, count(*) filter (where not is_won) as lost_count,
           count(*) as closed_count, cast(coalesce(sum(amount_usd) filter (where is_won), 0) as double) as won_amount_usd,
           cast(count(*) filter (where is_won) as double) / count(*) as win_rate,
           cast(coalesce(sum(amount_usd) filter (where is_won), 0) as double)
               / nullif(count(*) filter (where is_won), 0) as avg_deal_size_usd
    from (select a.industry as segment, a.billing_country as region, o.opportunity_type as product_line,
                 cast(date_trunc('quarter', o.close_date) as date) as fiscal_quarter, o.is_won, o.amount_usd
          from s_opportunity o join s_account a using (account_id) where o.is_closed)
    group by cube (segment, region, product_line, fiscal_quarter)""")
R.add("bookings", lambda c: sales.bookings(_opps(c)), """
    select cast(date_trunc('month', close_date) as date) as period, count(*) as deals,
           cast(sum(amount_usd) as double) as bookings_usd from s_opportunity where is_won group by 1""")
R.add("acv", lambda c: sales.average_contract_value(_opps(c)), """
    select cast(date_trunc('quarter', close_date) as date) as period, count(*) as deals,
           cast(sum(amount_usd) as double) as bookings_usd, cast(sum(amount_usd) as double) / count(*) as acv_usd
    from s_opportunity where is_won group by 1""")
R.add("sales_cycle", lambda c: sales.sales_cycle(_opps(c)), """
    select cast(date_trunc('quarter', close_date) as date) as period, count(*) as deals,
           cast(sum(date_diff('day', cast(created_at as date), close_date)) as double) / count(*) as avg_days,
           quantile_cont(date_diff('day', cast(created_at as date), close_date), 0.5) as median_days
    from s_opportunity where is_won group by 1""")
def _cycles(c, grain):
    won = _opps(c).filter("is_won").select(F.col("close_date").alias("day"), days_between(
        F.col("created_at").cast("date"), F.col("close_date")).alias("value"))
    return ranked(won, sketches.quantile_parts(won, F.col("value"), F.col("day")), grain)


for _grain in ("quarter", "year"):
    R.add(f"sales_cycle_quantiles_by_{_grain}", lambda c, g=_grain: _cycles(c, g), f"""
        select cast(date_trunc('{_grain}', close_date) as date) as period, p as probability, count(*) as observations,
               true as all_seen, true as within
        from s_opportunity cross join (values (0.1::double), (0.5::double), (0.9::double)) t(p) where is_won group by 1, 2""")
R.add("quota_attainment", lambda c: sales.quota_attainment(_opps(c), c.raw["raw_quota"]), """
    select q.owner_id, q.quarter_start, cast(q.quota_usd as double) as quota_usd,
           cast(coalesce(sum(o.amount_usd), 0) as double) as bookings_usd,
           cast(coalesce(sum(o.amount_usd), 0) as double) / cast(q.quota_usd as double) as attainment
    from raw_quota q left join s_opportunity o on o.is_won and o.owner_id = q.owner_id
         and date_trunc('quarter', o.close_date) = q.quarter_start group by 1, 2, q.quota_usd""")
R.add("forecast_accuracy", lambda c: sales.forecast_accuracy(
    sales.weighted_forecast(_opps(c)), sales.bookings(_opps(c), "quarter")), """
    with t as (select cast(date_trunc('quarter', close_date) as date) as period,
        sum(amount_usd * probability_pct * cast(0.01 as decimal(3,2))) as f,
        sum(amount_usd) filter (where is_won) as a from s_opportunity group by 1)
    select period, cast(f as double) as forecast_usd, cast(a as double) as actual_usd,
           cast(abs(f - a) as double) / nullif(cast(a as double), 0) as error_share from t where a is not null""")
R.add("pipeline_coverage", lambda c: sales.pipeline_coverage(_opps(c), c.raw["raw_quota"], 0.5), """
    select q.owner_id, q.quarter_start, cast(q.quota_usd as double) as quota_usd,
           cast(coalesce(sum(o.amount_usd), 0) as double) as pipeline_usd,
           cast(coalesce(sum(o.amount_usd), 0) as double) / cast(q.quota_usd as double) as coverage,
           cast(coalesce(sum(o.amount_usd), 0) as double) / cast(q.quota_usd as double) >= 0.5 as is_covered
    from raw_quota q left join s_opportunity o on not o.is_closed and o.owner_id = q.owner_id
         and date_trunc('quarter', o.close_date) = q.quarter_start group by 1, 2, q.quota_usd""")
R.add("stage_conversion", lambda c: sales.stage_conversion(c.raw["raw_opportunity_history"]), """
    with n as (select stage_name, lead(stage_name) over (partition by opportunity_id
               order by changed_at, version, stage_name, amount) as next_stage_name from raw_opportunity_history)
    select stage_name, next_stage_name, count(*) as moves,
           cast(count(*) as double) / sum(count(*)) over (partition by stage_name) as share
    from n group by 1, 2""")

# --- marketing
R.add("funnel_metrics", lambda c: c.marts.funnel_metrics, """
    select activity_month, mql_count, qualified_count, cast(marketing_spend_usd as double) as marketing_spend_usd,
           cast(marketing_spend_usd as double) / mql_count as cost_per_mql_usd from m_funnel""")
R.add("funnel_spend_join", lambda c: c.marts.funnel_metrics.select("activity_month", "marketing_spend_usd"),
      "select activity_month, cast(marketing_spend_usd as double) as marketing_spend_usd from m_funnel")
R.add("funnel_conversion", lambda c: marketing.funnel_conversion(c.marts.contacts), """
    select cast(date_trunc('month', created_at) as date) as activity_month,
           count(*) filter (where lifecycle_stage = 'marketingqualifiedlead') as mqls,
           count(*) filter (where lifecycle_stage = 'salesqualifiedlead') as sqls,
           cast(count(*) filter (where lifecycle_stage = 'salesqualifiedlead') as double)
             / nullif(count(*) filter (where lifecycle_stage = 'marketingqualifiedlead'), 0) as mql_to_sql_rate
    from s_contact group by 1""")
R.add("funnel_reached", lambda c: marketing.funnel_reached(c.marts.contacts), """
    with r as (select cast(date_trunc('month', created_at) as date) as activity_month,
           count(*) filter (where lifecycle_stage in ('marketingqualifiedlead', 'salesqualifiedlead', 'opportunity')) as reached_mql,
           count(*) filter (where lifecycle_stage in ('salesqualifiedlead', 'opportunity')) as reached_sql
        from s_contact group by 1)
    select *, cast(reached_sql as double) / nullif(reached_mql, 0) as mql_to_sql_rate from r""")
R.add("daily_mqls", lambda c: marketing.daily_mqls(c.marts.contacts), """
    select cast(created_at as date) as activity_date, count(*) as mqls from s_contact
    where lifecycle_stage = 'marketingqualifiedlead' group by 1""")
R.add("cost_per_mql", lambda c: marketing.cost_per_mql(
    c.marts.contacts.join(c.raw["raw_opportunity"].select(F.col("id").alias("contact_id"),
                                                          F.col("lead_source").alias("channel")), "contact_id"),
    c.raw["raw_ad_spend"]), """
    with l as (select o.lead_source as channel, date_trunc('month', created_at)::date as m, count(*) as mqls
               from s_contact c join raw_opportunity o on o.id = c.contact_id
               where lifecycle_stage = 'marketingqualifiedlead' group by 1, 2),
    s as (select channel, date_trunc('month', activity_date)::date as m, sum(spend_usd) as spend
          from raw_ad_spend group by 1, 2)
    select s.channel, s.m as activity_month, cast(spend as double) as spend_usd, coalesce(mqls, 0) as mqls,
           cast(spend as double) / mqls as cost_per_mql_usd
    from s left join l on l.channel = s.channel and l.m = s.m""")
# An opportunity's lead is the contact that carries its number.
_LEADS = """
    select o.opportunity_id, c.created_at as lead_created_at, o.created_at, o.amount_usd, o.is_won, o.close_date
    from s_opportunity o join s_contact c on c.contact_id = o.opportunity_id"""


def _lead_opps(c):
    return _opps(c).join(c.marts.contacts.select(F.col("contact_id").alias("opportunity_id"),
                                                 F.col("created_at").alias("lead_created_at")), "opportunity_id")


def _touches(c):
    return c.raw["raw_touch"].withColumn("touched_at", F.col("touched_at").cast("timestamp_ntz"))


_WEIGHTS = f"""
    l as ({_LEADS}),
    t as (select touch_id, opportunity_id, campaign_id, touched_at from raw_touch),
    d as (select t.*, l.lead_created_at, l.created_at as opp_created_at from t join l using (opportunity_id)),
    r as (select *,
        row_number() over (partition by opportunity_id order by touched_at, touch_id) = 1 as is_first,
        touched_at <= lead_created_at and row_number() over (partition by opportunity_id, touched_at <= lead_created_at
            order by touched_at desc, touch_id desc) = 1 as is_lead,
        touched_at <= opp_created_at and row_number() over (partition by opportunity_id, touched_at <= opp_created_at
            order by touched_at desc, touch_id desc) = 1 as is_opp from d),
    h as (select *, is_first::int + is_lead::int + is_opp::int as hits from r),
    g as (select *, count(*) filter (where hits = 0) over (partition by opportunity_id) as others,
                 sum(hits) over (partition by opportunity_id) as marks from h),
    w as (select touch_id, opportunity_id, campaign_id, touched_at,
        round((case when hits > 0 then hits * 0.3::double else 0.1::double / others end)
              / (marks * 0.3::double + case when others > 0 then 0.1::double else 0 end), 9) as weight from g)"""
R.add("attribution_w", lambda c: marketing.attribution_w(_touches(c), _lead_opps(c)).withColumn(
    "weight", F.round("weight", 9)), f"with {_WEIGHTS} select * from w")
def _attributed(c, which, at, name):
    """Amounts of some opportunities, dealt to campaigns by weight, on the day that ``at`` names."""
    return (marketing.attribution_w(_touches(c), _lead_opps(c))
            .join(_lead_opps(c).filter(which).select("opportunity_id", at.alias("activity_date"), "amount_usd"), "opportunity_id")
            .select("campaign_id", "activity_date", (F.round("weight", 9).cast("decimal(10,9)") * F.col("amount_usd")).alias(name)))


def _campaign_days(c):
    return marketing.campaign_performance(
        c.raw["raw_ad_spend"], _attributed(c, "is_won", F.col("close_date"), "attributed_revenue_usd"))


def _campaign_report(c):
    return marketing.campaign_report(
        c.raw["raw_ad_spend"], c.raw["raw_campaign"],
        _attributed(c, "is_won", F.col("close_date"), "attributed_revenue_usd"),
        _attributed(c, "not is_closed", F.col("created_at").cast("date"), "attributed_pipeline_usd"),
        marketing.lead_campaigns(c.marts.contacts, _touches(c)))


def _rounded(df):
    return df.withColumns({"attributed_revenue_usd": F.round("attributed_revenue_usd", 2), "roas": F.round("roas", 6)})


R.add("campaign_performance", lambda c: _rounded(_campaign_days(c)), f"""
    with {_WEIGHTS},
    a as (select campaign_id, close_date as activity_date,
                 sum(cast(weight as decimal(10,9)) * amount_usd) as earned
          from w join l using (opportunity_id) where is_won group by 1, 2),
    s as (select campaign_id, activity_date, sum(spend_usd) as spend, sum(impressions) as impressions,
                 sum(clicks) as clicks from raw_ad_spend group by 1, 2)
    select coalesce(s.campaign_id, a.campaign_id) as campaign_id,
           coalesce(s.activity_date, a.activity_date) as activity_date, cast(coalesce(spend, 0) as double) as spend_usd,
           cast(coalesce(impressions, 0) as bigint) as impressions, cast(coalesce(clicks, 0) as bigint) as clicks,
           cast(round(coalesce(earned, 0), 2) as double) as attributed_revenue_usd,
           round(cast(coalesce(earned, 0) as double) / nullif(cast(spend as double), 0), 6) as roas
    from s full join a on a.campaign_id = s.campaign_id and a.activity_date = s.activity_date""")
R.add("campaign_returns", lambda c: _rounded(marketing.campaign_returns(_campaign_days(c))), f"""
    with {_WEIGHTS},
    a as (select campaign_id, date_trunc('month', close_date)::date as activity_month,
                 sum(cast(weight as decimal(10,9)) * amount_usd) as earned
          from w join l using (opportunity_id) where is_won group by 1, 2),
    s as (select campaign_id, date_trunc('month', activity_date)::date as activity_month, sum(spend_usd) as spend,
                 sum(impressions) as impressions, sum(clicks) as clicks from raw_ad_spend group by 1, 2)
    select coalesce(s.campaign_id, a.campaign_id) as campaign_id, coalesce(s.activity_month, a.activity_month) as activity_month,
           cast(coalesce(spend, 0) as double) as spend_usd, cast(coalesce(impressions, 0) as bigint) as impressions,
           cast(coalesce(clicks, 0) as bigint) as clicks,
           cast(round(coalesce(earned, 0), 2) as double) as attributed_revenue_usd,
           round(cast(coalesce(earned, 0) as double) / nullif(cast(coalesce(spend, 0) as double), 0), 6) as roas
    from s full join a on a.campaign_id = s.campaign_id and a.activity_month = s.activity_month""")
R.add("campaign_report", _campaign_report, f"""
    with {_WEIGHTS},
    f as (select opportunity_id as contact_id, campaign_id from (select *, row_number() over (
              partition by opportunity_id order by touched_at, touch_id) as rn from raw_touch) where rn = 1),
    a as (select campaign_id, activity_date, spend_usd as spend, impressions, clicks, null as piped,
                 null as earned, 0 as mql from raw_ad_spend
          union all
          select campaign_id, cast(created_at as date), null, null, null, cast(weight as decimal(10,9)) * amount_usd, null, 0
          from w join s_opportunity using (opportunity_id) where not is_closed
          union all
          select campaign_id, close_date, null, null, null, null, cast(weight as decimal(10,9)) * amount_usd, 0
          from w join s_opportunity using (opportunity_id) where is_won
          union all
          select campaign_id, cast(created_at as date), null, null, null, null, null, 1 from s_contact join f using (contact_id)
          where lifecycle_stage = 'marketingqualifiedlead')
    select campaign_id, activity_date, any_value(campaign_name) as campaign_name, any_value(channel) as channel,
           cast(coalesce(sum(spend), 0) as double) as spend_usd, cast(coalesce(sum(impressions), 0) as integer) as impressions,
           cast(coalesce(sum(clicks), 0) as integer) as clicks, cast(sum(mql) as integer) as mql_count,
           cast(round(coalesce(sum(piped), 0), 2) as double) as attributed_pipeline_usd,
           cast(try_cast(cast(coalesce(sum(earned), 0) as double) / nullif(cast(coalesce(sum(spend), 0) as double), 0)
                as decimal(8,4)) as double) as roas
    from a left join raw_campaign using (campaign_id) group by 1, 2""")
R.add("campaign_contract", lambda c: contract_check(_campaign_report(c), CAMPAIGNS), """
    select 'campaign_performance' as table_name, unnest(['schema_activity_date', 'schema_attributed_pipeline_usd',
           'schema_campaign_id', 'schema_campaign_name', 'schema_channel', 'schema_clicks', 'schema_impressions',
           'schema_mql_count', 'schema_roas', 'schema_spend_usd', 'not_null_campaign_id', 'not_null_activity_date',
           'between_spend_usd', 'between_mql_count', 'unique_campaign_id_activity_date']) as test_name,
           2 as tier, cast(0 as bigint) as failures, 'pass' as status""")
R.add("pipeline_influenced", lambda c: marketing.pipeline_influenced(_opps(c), c.raw["raw_touch"]), """
    select cast(date_trunc('month', close_date) as date) as close_month, cast(sum(amount_usd) as double) as pipeline_usd,
           cast(coalesce(sum(amount_usd) filter (where touched), 0) as double) as influenced_usd,
           cast(coalesce(sum(amount_usd) filter (where touched), 0) as double) / cast(sum(amount_usd) as double)
               as influenced_share
    from (select *, opportunity_id in (select opportunity_id from raw_touch) as touched from s_opportunity
          where not is_closed) group by 1""")
R.add("utm_params", lambda c: marketing.utm_params(c.base("pages").select("page_id", "url"), "url",
                                                   ["utm_source", "ref", "page"]), """
    select page_id, url, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') as utm_source,
           nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page from pages""")
