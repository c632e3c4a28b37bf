"""SQL counterparts: shared fragments that each oracle query pulls in by name."""

from __future__ import annotations

import re

from workload.bindings import AS_OF_ORDERS, BINDINGS, SPINE_START, TEST_ACCOUNTS

_TESTS = ", ".join(f"'{i}'" for i in TEST_ACCOUNTS)

FRAGMENTS: dict[str, str] = {name: b.sql() for name, b in BINDINGS.items()}
FRAGMENTS["raw_billing_customer"] = (
    "select * from raw_billing_customer_1 union all select * from raw_billing_customer_2")
FRAGMENTS.update({
    "s_account": f"""
        select id as account_id, name as account_name, industry, type as account_type, annual_revenue,
               number_of_employees, billing_country, created_date as created_at, last_modified_date as updated_at,
               is_deleted, synced_at as loaded_at
        from raw_account where is_deleted is distinct from true and id not in ({_TESTS})""",
    "s_opportunity": """
        select id as opportunity_id, account_id, name as opportunity_name, stage_name, amount as amount_usd,
               probability as probability_pct, is_closed, is_won, close_date, created_date as created_at, owner_id,
               type as opportunity_type, lead_source, synced_at as loaded_at
        from raw_opportunity where is_deleted is distinct from true""",
    "s_real_opportunity": f"select * from s_opportunity where account_id is null or account_id not in ({_TESTS})",
    "s_customer": """
        select id as customer_id, email, name as customer_name,
               json_extract_string(metadata, '$.account_id') as salesforce_account_id,
               created as created_at, synced_at as loaded_at
        from raw_billing_customer""",
    "s_subscription": """
        select id as subscription_id, customer_id, status as subscription_status, plan_amount as cents,
               cast(plan_amount / 100.0 as double) as plan_amount_usd, plan_interval,
               current_period_start as period_start_at, current_period_end as period_end_at, canceled_at,
               created as created_at, synced_at as loaded_at
        from raw_subscription""",
    "s_contact": """
        select id as contact_id, property_email as email, property_firstname as first_name,
               property_lastname as last_name, property_lifecyclestage as lifecycle_stage,
               property_hs_lead_status as lead_status, property_createdate as created_at, synced_at as loaded_at
        from raw_contact""",
    "s_worker": """
        select worker_id as employee_id, email, first_name, last_name, department, cost_center, job_title,
               employment_status, hire_date, termination_date, fte, manager_id, synced_at as loaded_at
        from raw_worker""",
    # Cents per year: whole numbers, so sums are exact and are divided once.
    "s_mrr": """
        select s.subscription_id, a.account_id, s.customer_id, s.subscription_status, s.plan_amount_usd,
               s.plan_interval,
               case s.plan_interval when 'month' then 12 * s.cents when 'year' then s.cents end as annual_cents,
               s.period_start_at, s.period_end_at, s.canceled_at, s.created_at
        from s_subscription s join s_customer c on s.customer_id = c.customer_id
        left join s_account a on a.account_id = c.salesforce_account_id
        where s.subscription_status in ('active', 'trialing', 'past_due')""",
    "months": f"""
        select cast(m as date) as revenue_month
        from generate_series(timestamp '{SPINE_START}', timestamp '{AS_OF_ORDERS}', interval 1 month) g(m)""",
    "m_revenue_cents": """
        select a.account_id, d.revenue_month, cast(coalesce(sum(m.annual_cents), 0) as bigint) as cents
        from s_account a cross join months d
        left join s_mrr m on m.account_id = a.account_id
             and cast(d.revenue_month as timestamp) between date_trunc('month', m.period_start_at)
                 and coalesce(m.canceled_at, m.period_end_at)
        group by 1, 2""",
    # Half up to whole cents: (cents / 12) rounded in integers.
    "m_revenue": """
        select account_id, revenue_month, ((2 * cents + 12) // 24) / 100.0 as mrr_usd, cents / 100.0 as arr_usd,
               (2 * cents + 12) // 24 as mrr_cents, cents
        from m_revenue_cents""",
    "m_margin_parts": """
        select cast(date_trunc('month', transaction_date) as date) as revenue_month, product_line, currency,
               case account_type when 'Income' then amount end as income,
               case account_type when 'COGS' then amount end as cost
        from raw_transaction""",
    "m_margin": """
        select revenue_month, sum(income) as revenue_usd, coalesce(sum(cost), 0) as cogs_usd
        from m_margin_parts group by 1 having count(income) > 0""",
    "m_win": """
        select cast(date_trunc('quarter', close_date) as date) as fiscal_quarter,
               count(*) filter (where is_won) as won_count, count(*) filter (where not is_won) as lost_count,
               count(*) as closed_count, coalesce(sum(amount_usd) filter (where is_won), 0) as won_amount_usd
        from s_opportunity where is_closed group by 1""",
    "m_funnel": """
        select c.activity_month, c.mql_count, c.qualified_count,
               coalesce(s.spend, 0) as marketing_spend_usd
        from (select cast(date_trunc('month', created_at) as date) as activity_month, count(*) as mql_count,
                     count(*) filter (where lifecycle_stage = 'marketingqualifiedlead') as qualified_count
              from s_contact group by 1) c
        left join (select cast(date_trunc('month', activity_date) as date) as activity_month, sum(spend_usd) as spend
                   from raw_ad_spend group by 1) s on s.activity_month = c.activity_month""",
    "e_active": """
        select * from raw_event where account_id is not null and event_name not in ('session_start', 'first_open')""",
    "m_engagement": """
        select event_date as activity_date, account_id, count(distinct user_id) as dau, count(*) as event_count,
               count(distinct session_id) as sessions,
               array_to_string(list_sort(list(distinct event_name)), ',') as features_used
        from e_active group by 1, 2""",
    "m_real_engagement": f"select * from m_engagement where account_id not in ({_TESTS})",
    "m_headcount": f"""
        select date_trunc('month', date '{AS_OF_ORDERS}')::date as snapshot_month, department,
               count(*) filter (where employment_status = 'Active') as headcount,
               count(*) filter (where termination_date >= date '{AS_OF_ORDERS}' - interval 1 month)
                   as terminations_last_month,
               sum(date_diff('day', hire_date, coalesce(termination_date, date '{AS_OF_ORDERS}'))) as tenure_days,
               count(hire_date) as tenure_workers
        from s_worker group by 2""",
})


def oracle(body: str) -> str:
    """``body`` with the fragments it names in front, in dependency order."""
    chosen: dict[str, str] = {}

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if word in FRAGMENTS and word not in chosen:
                need(FRAGMENTS[word])
                chosen.setdefault(word, FRAGMENTS[word])

    need(body)
    if not chosen:
        return body.strip()
    heads = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in chosen.items())
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {heads},\n{body[5:]}"
    return f"with {heads}\n{body}"
