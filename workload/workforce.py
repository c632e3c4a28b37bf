"""People queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.operators import people, sketches
from workload.bindings import AS_OF_ORDERS, SPINE_START
from workload.context import Registry
from workload.ranks import ranked

R = Registry()

R.add("headcount", lambda c: people.headcount(c.marts.workers, AS_OF_ORDERS), """
    select snapshot_month, department, headcount, terminations_last_month,
           cast(tenure_days as double) / tenure_workers as avg_tenure_days, cast(tenure_days as bigint) as tenure_days,
           tenure_workers from m_headcount""")
R.add("headcount_capped", lambda c: people.headcount(c.marts.workers, AS_OF_ORDERS, cap_at_as_of=True).select(
    "department", "terminations_last_month"), f"""
    select department, count(*) filter (where termination_date between date '{AS_OF_ORDERS}' - interval 1 month
           and date '{AS_OF_ORDERS}') as terminations_last_month from s_worker group by 1""")
R.add("hr_rollup", lambda c: people.hr_rollup(c.marts.monthly_headcount).selectExpr(
    "activity_month", "headcount", "terminations", "round(avg_tenure_days, 9) as avg_tenure_days",
    "weighted_tenure_days"), """
    select snapshot_month as activity_month, cast(sum(headcount) as bigint) as headcount,
           cast(sum(terminations_last_month) as bigint) as terminations,
           round(avg(tenure_days / tenure_workers), 9) as avg_tenure_days,
           cast(sum(tenure_days) as double) / sum(tenure_workers) as weighted_tenure_days
    from m_headcount group by 1""")
_HISTORY = """
    h as (select d.department, m.revenue_month as month,
             count(w.employee_id) filter (where w.hire_date <= last_day(m.revenue_month)
                 and (w.termination_date is null or w.termination_date > last_day(m.revenue_month))) as headcount,
             count(*) filter (where date_trunc('month', w.hire_date) = m.revenue_month) as hires,
             count(*) filter (where date_trunc('month', w.termination_date) = m.revenue_month) as terminations
          from (select distinct department from s_worker) d cross join months m
          join s_worker w on w.department = d.department group by 1, 2)"""
R.add("headcount_monthly", lambda c: people.headcount_monthly(c.marts.workers, SPINE_START, AS_OF_ORDERS).drop("change"),
      f"with {_HISTORY} select * from h")
R.add("attrition_avg", lambda c: people.attrition_avg(people.headcount_monthly(
    c.marts.workers, SPINE_START, AS_OF_ORDERS)), f"""
    with {_HISTORY},
    t as (select month, sum(headcount) as n, sum(hires) as hires, sum(terminations) as gone from h group by 1),
    o as (select *, n - hires + gone as opening from t)
    select month, cast(gone as bigint) as terminations, (n + opening) / 2.0 as avg_headcount,
           cast(gone as double) / nullif((n + opening) / 2.0, 0) as attrition_rate from o""")
R.add("attrition_by_department", lambda c: people.attrition_avg(people.headcount_monthly(
    c.marts.workers, SPINE_START, AS_OF_ORDERS), ["department"]), f"""
    with {_HISTORY},
    o as (select *, headcount - hires + terminations as opening from h)
    select month, department, cast(terminations as bigint) as terminations, (headcount + opening) / 2.0 as avg_headcount,
           cast(terminations as double) / nullif((headcount + opening) / 2.0, 0) as attrition_rate from o""")
R.add("employee_months", lambda c: people.employee_months(c.marts.workers, SPINE_START, AS_OF_ORDERS), f"""
    select employee_id, revenue_month as month, department, cost_center, cast(fte as double) as fte,
           termination_date is null or termination_date > last_day(revenue_month) as is_active
    from s_worker join months on revenue_month between date_trunc('month', hire_date)
         and date_trunc('month', coalesce(termination_date, date '{AS_OF_ORDERS}'))""")
R.add("time_to_hire", lambda c: people.time_to_hire(c.raw["raw_requisition"]), """
    select department, count(*) as hires, cast(sum(accepted_date - opened_date) as double) / count(*) as avg_days,
           quantile_cont(accepted_date - opened_date, 0.5) as median_days
    from raw_requisition where accepted_date is not null group by 1""")


def _hiring_times(c):
    filled = c.raw["raw_requisition"].filter("accepted_date is not null").select(
        "department", F.col("accepted_date").alias("day"),
        days_between(F.col("opened_date"), F.col("accepted_date")).alias("value"))
    return ranked(filled, sketches.quantile_parts(filled, F.col("value"), F.col("day"), ["department"]), "year", ["department"])


R.add("time_to_hire_quantiles", _hiring_times, """
    select cast(date_trunc('year', accepted_date) as date) as period, department, p as probability, count(*) as observations,
           true as all_seen, true as within
    from raw_requisition cross join (values (0.1::double), (0.5::double), (0.9::double)) t(p)
    where accepted_date is not null group by 1, 2, 3""")
R.add("open_reqs", lambda c: people.open_reqs(c.raw["raw_requisition"], "1995-01-02", AS_OF_ORDERS), f"""
    select cast(g as date) as week, count(r.id) as open_reqs
    from generate_series(timestamp '1995-01-02', timestamp '{AS_OF_ORDERS}', interval 7 day) t(g)
    left join raw_requisition r on r.opened_date <= cast(g as date)
         and (r.accepted_date is null or r.accepted_date > cast(g as date)) group by 1""")
R.add("span_of_control", lambda c: people.span_of_control(c.marts.workers), """
    select manager_id, count(*) as direct_reports from s_worker where manager_id is not null group by 1""")
