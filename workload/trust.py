"""Governance, quality and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import masks, values
from tidemark.operators import governance, history, quality
from tidemark.operators.quality import Between, NotNull, Unique
from tidemark.operators.skew import hot_keys
from tidemark.plans import contracts
from tidemark.session import checkpointed, work_dir
from tidemark.sources import keyed
from workload.bindings import AS_OF_EVENTS, AS_OF_ORDERS
from workload.context import Registry
from workload.oracle import FRAGMENTS

R = Registry()

# --- masks
for _role in ("analyst", "hr"):
    R.add(f"mask_columns_{_role}", lambda c, r=_role: c.raw["raw_worker"].select(
        "worker_id", masks.mask_email(F.col("email"), r).alias("email"),
        masks.mask_phone(F.col("phone"), r).alias("phone"),
        masks.mask_amount(F.col("salary"), r).alias("salary"),
        masks.mask_id(F.col("manager_id"), r).alias("manager_id")), {
        "analyst": """
            select worker_id, regexp_replace(email, '.+@', '***@') as email, '***-***-' || right(phone, 4) as phone,
                   cast(null as double) as salary, sha256(manager_id) as manager_id from raw_worker""",
        "hr": "select worker_id, email, phone, cast(salary as double) as salary, manager_id from raw_worker"}[_role])
R.add("mask_email", lambda c: c.raw["raw_billing_customer"].select(
    "id", masks.mask_email(F.col("email"), "finance").alias("email")),
    "select id, regexp_replace(email, '.+@', '***@') as email from raw_billing_customer")
R.add("mask_phone", lambda c: c.raw["raw_worker"].select("worker_id", masks.mask_phone(F.col("phone"), "engineer")
                                                         .alias("phone")),
      "select worker_id, '***-***-' || right(phone, 4) as phone from raw_worker")
R.add("mask_amount", lambda c: c.raw["raw_worker"].select("worker_id", masks.mask_amount(F.col("salary"), "engineer")
                                                          .alias("salary")),
      "select worker_id, cast(null as double) as salary from raw_worker")
R.add("mask_id", lambda c: c.raw["raw_account"].select(masks.mask_id(F.col("id"), "sales").alias("id"), "industry"),
      "select sha256(id) as id, industry from raw_account")

WORKER_TAGS = {
    "employee_id": {"classification": "pii", "owner": "people-data", "retention_days": 2555, "policy": "id"},
    "email": {"classification": "pii", "owner": "people-data", "retention_days": 2555, "policy": "email"},
    "phone": {"classification": "pii", "owner": "people-data", "retention_days": 2555, "policy": "phone"},
    "salary": {"classification": "financial", "owner": "people-data", "retention_days": 2555, "policy": "amount"},
}


def _tagged_workers(c):
    workers = c.raw["raw_worker"].select(F.col("worker_id").alias("employee_id"), "email", "phone", "salary",
                                         "first_name", "last_name", "department")
    return governance.tag_columns(workers, WORKER_TAGS)


R.add("apply_policies", lambda c: governance.apply_policies(_tagged_workers(c), "engineer"), """
    select sha256(worker_id) as employee_id, email, '***-***-' || right(phone, 4) as phone,
           cast(null as double) as salary, first_name, last_name, department from raw_worker""")
R.add("territory_filter", lambda c: governance.row_access(
    c.raw["raw_account"].select("id", "territory_id"), "sales", "rep2@example.com", c.raw["raw_user_territory"]), """
    select id, territory_id from raw_account where territory_id in (select territory_id from raw_user_territory
    where user_email = 'rep2@example.com')""")
R.add("row_access", lambda c: governance.row_access(
    c.raw["raw_account"].select("id", "territory_id"), "finance", "nobody@example.com", c.raw["raw_user_territory"]),
    "select id, territory_id from raw_account")
R.add("access_log", lambda c: governance.access_log(c.raw["raw_access_history"], AS_OF_EVENTS), f"""
    select sha256(query_id || '-' || strftime(start_time, '%Y-%m-%d %H:%M:%S')) as log_id, query_id, user_name,
           cast(null as varchar) as role_name, warehouse_name, query_text,
           cast(null as varchar) as database_name, cast(null as varchar) as schema_name, objects_accessed,
           start_time as query_start_time, timestamp '{AS_OF_EVENTS}' as loaded_at
    from raw_access_history where start_time >= timestamp '{AS_OF_EVENTS}' - interval 1 day
      and objects_accessed is not null""")
_EMAIL, _PHONE = governance.CONTENT_PATTERNS["email"], governance.CONTENT_PATTERNS["phone"]


def _pii_row(table: str, column: str, kind: str, tag: tuple | None = None) -> str:
    cls, owner, days = tag or (None, None, None)
    text = kind == "string"
    email = f"count(*) filter (where regexp_matches({column}, '{_EMAIL}'))" if text else "0"
    phone = f"count(*) filter (where regexp_matches({column}, '{_PHONE}'))" if text else "0"
    quoted = lambda v: f"'{v}'" if v else "null"
    return (f"select '{table}' as table_name, '{column}' as column_name, '{kind}' as data_type, "
            f"cast({quoted(cls)} as varchar) as classification, cast({quoted(owner)} as varchar) as owner, "
            f"cast({days or 'null'} as integer) as retention_days, count(*) as row_count, "
            f"cast({email} as bigint) as email_rows, cast({phone} as bigint) as phone_rows, "
            f"{'false' if cls == 'pii' else f'{email} + {phone} > 0'} as is_untagged_hit from {table}")


_PII_SQL = " union all ".join(
    [_pii_row("documents", "doc_id", "bigint"), _pii_row("documents", "text", "string"),
     _pii_row("documents", "lang", "string"), _pii_row("documents", "source", "string")]
    + [_pii_row("w", n, k, t) for n, k, t in (
        ("employee_id", "string", ("pii", "people-data", 2555)), ("email", "string", ("pii", "people-data", 2555)),
        ("phone", "string", ("pii", "people-data", 2555)), ("salary", "decimal(18,2)", ("financial", "people-data", 2555)),
        ("first_name", "string", None), ("last_name", "string", None), ("department", "string", None))])
R.add("pii_inventory", lambda c: governance.pii_inventory({
    "documents": c.base("documents").select("doc_id", "text", "lang", "source"), "w": _tagged_workers(c)}),
    "with w as (select worker_id as employee_id, email, phone, salary, first_name, last_name, department "
    f"from raw_worker) {_PII_SQL}")
_SUBJECTS = "select cast(c_custkey as varchar) as id from customer where c_acctbal < 0"


def _subjects(c):
    return c.base("customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("id"))


R.add("erase_subjects", lambda c: governance.erase_subjects(
    c.raw["raw_event"].select("event_id", "account_id"), "account_id", _subjects(c)), f"""
    select event_id, account_id from raw_event e where not exists (
        select 1 from ({_SUBJECTS}) s where s.id = e.account_id)""")
R.add("erasure_log", lambda c: governance.erasure_log(
    c.raw["raw_event"], "events", "account_id", _subjects(c), AS_OF_EVENTS), f"""
    select 'events' as table_name, sha256(s.id) as subject_hash, count(e.event_id) as rows_erased,
           date '{AS_OF_EVENTS}' as erased_on
    from ({_SUBJECTS}) s left join raw_event e on e.account_id = s.id group by s.id""")
R.add("retention_hot", lambda c: governance.apply_retention(c.raw["raw_event"], "event_date", AS_OF_EVENTS, 10)[0]
      .select("event_id", "event_date"),
      f"select event_id, event_date from raw_event where event_date >= date '{AS_OF_EVENTS}' - 10")
R.add("retention_archive", lambda c: governance.apply_retention(c.raw["raw_transaction"], "transaction_date",
                                                                AS_OF_ORDERS, 90, 1825)[1]
      .select("id", "transaction_date", "amount"), f"""
    select id, transaction_date, cast(amount as double) as amount from raw_transaction
    where transaction_date < date '{AS_OF_ORDERS}' - 90 and transaction_date >= date '{AS_OF_ORDERS}' - 1825""")
R.add("forbidden_columns", lambda c: governance.forbidden_columns_report({
    "hr.workers": _tagged_workers(c), "sales.owners": _tagged_workers(c).select("employee_id", "last_name", "department"),
    "marketing.contacts": c.marts.contacts.select("contact_id", "first_name")}), """
    select 'sales.owners' as table_name, 'employee_id' as column_name, 'tagged pii' as reason,
           count(worker_id) as exposed_values from raw_worker
    union all select 'sales.owners', 'last_name', 'personal name', count(last_name) from raw_worker
    union all select 'marketing.contacts', 'first_name', 'personal name', count(first_name) from s_contact""")

# --- quality
R.add("not_null", lambda c: quality.not_null(c.raw["raw_event"], "account_id").select("event_id", "user_id"),
      "select event_id, user_id from raw_event where account_id is null")
R.add("unique", lambda c: quality.unique(c.raw["raw_transaction"], "id"),
      "select id, count(*) as n_records from raw_transaction group by 1 having count(*) > 1")
R.add("unique_combination", lambda c: quality.unique_combination(
    c.raw["raw_opportunity_history"], ["opportunity_id", "changed_at"]).withColumn(
    "changed_at", F.col("changed_at").cast("timestamp_ntz")), """
    select opportunity_id, changed_at, count(*) as n_records from raw_opportunity_history group by 1, 2
    having count(*) > 1""")
R.add("between", lambda c: quality.between(c.raw["raw_account"], "annual_revenue", 0, 9000000)
      .select("id", "annual_revenue"), """
    select id, cast(annual_revenue as double) as annual_revenue from raw_account
    where annual_revenue < 0 or annual_revenue > 9000000""")
R.add("freshness", lambda c: quality.freshness(
    {"account": c.raw["raw_account"], "subscription": c.raw["raw_subscription"],
     "worker": c.raw["raw_worker"]}, "synced_at", "2001-08-01 13:30:00"),
    " union all ".join(f"""
    select '{n}' as source_name, max(synced_at) as max_loaded_at,
           cast(date_diff('second', max(synced_at), timestamp '2001-08-01 13:30:00') as double) / 3600.0 as age_hours,
           case when max(synced_at) is null
                  or date_diff('second', max(synced_at), timestamp '2001-08-01 13:30:00') > 86400 then 'error'
                when date_diff('second', max(synced_at), timestamp '2001-08-01 13:30:00') > 43200 then 'warn'
                else 'pass' end as status from raw_{n} {w}"""
                   for n, w in (("account", ""), ("subscription", ""), ("worker", ""))))
TESTS = {
    "monthly_revenue": [NotNull("account_id"), NotNull("revenue_month"), NotNull("mrr_usd"), NotNull("arr_usd"),
                        Between("mrr_usd", 0), Unique(("account_id", "revenue_month"))],
    "pipeline_snapshot": [NotNull("opportunity_id"), Unique(("opportunity_id",)), Between("amount_usd", 0)],
    "daily_engagement": [NotNull("activity_date"), Unique(("activity_date",))],
    "account": [NotNull("id"), Unique(("id",)), Between("annual_revenue", 0)],
    "event": [NotNull("account_id"), Unique(("user_id", "event_date"))],
}
TIERS = {"monthly_revenue": 1, "pipeline_snapshot": 1, "daily_engagement": 2, "account": 1, "event": 3}


def _suite(c):
    tables = {"monthly_revenue": c.marts.monthly_revenue, "pipeline_snapshot": c.marts.pipeline_snapshot,
              "daily_engagement": c.marts.daily_engagement, "account": c.raw["raw_account"],
              "event": c.raw["raw_event"]}
    return quality.run_suite(tables, TESTS, TIERS)


_PLANNED = ", ".join(f"('{t}', '{x.name}', {TIERS[t]})" for t, xs in TESTS.items() for x in xs)
_SUITE = f"""
    f as (select 'account' as tn, 'between_annual_revenue' as xn,
                 (select count(*) from raw_account where annual_revenue < 0) as n
          union all select 'event', 'not_null_account_id', (select count(*) from raw_event where account_id is null)
          union all select 'event', 'unique_user_id_event_date', (select count(*) from
              (select 1 from raw_event group by user_id, event_date having count(*) > 1))),
    suite as (select t as table_name, x as test_name, tier, coalesce(f.n, 0) as failures,
                     case when f.n > 0 then 'fail' else 'pass' end as status
              from (values {_PLANNED}) p(t, x, tier) left join f on f.tn = p.t and f.xn = p.x)"""
R.add("run_suite", _suite, f"with {_SUITE} select * from suite")
R.add("pass_rate", lambda c: quality.pass_rate(_suite(c)), f"""
    with {_SUITE}, r as (select tier, count(*) as tests, count(*) filter (where status = 'pass') as passed
                         from suite group by 1)
    select tier, tests, passed, cast(passed as double) / tests as pass_rate,
           cast(case tier when 1 then 0.99 when 2 then 0.98 else 0.95 end as double) as target,
           cast(passed as double) / tests >= case tier when 1 then 0.99 when 2 then 0.98 else 0.95 end as meets_target
    from r""")
R.add("alert_rules", lambda c: quality.alert_rules(quality.freshness(
    {"account": c.raw["raw_account"], "transaction": c.raw["raw_transaction"].withColumn(
        "synced_at", F.col("transaction_date").cast("timestamp_ntz"))}, "synced_at", "2001-08-01 03:00:00"), _suite(c)),
    f"""with {_SUITE},
    ages as (select 'account' as subject, date_diff('second', max(synced_at), timestamp '2001-08-01 03:00:00') as s
             from raw_account
             union all select 'transaction', date_diff('second', max(cast(transaction_date as timestamp)),
                 timestamp '2001-08-01 03:00:00') from raw_transaction)
    select 'stale_source' as rule, 'P1' as severity, subject from ages where s > 21600
    union all select 'sync_lag', 'P2', subject from ages where s > 7200
    union all select 'tier1_test_failure', 'P1', table_name || '.' || test_name from suite
              where tier = 1 and status = 'fail'""")


def _stored_failures(c):
    path = work_dir(c.spark, "failures")
    quality.store_failures(c.raw["raw_event"].select("event_id", "account_id"), NotNull("account_id"), path)
    return c.spark.read.schema("event_id string, account_id string").parquet(f"{path}/not_null_account_id")


R.add("store_failures", _stored_failures, "select event_id, account_id from raw_event where account_id is null")
R.add("contract_check", lambda c: contracts.contract_check(c.marts.monthly_revenue, contracts.REVENUE).unionByName(
    contracts.contract_check(c.marts.pipeline_snapshot.drop("is_won"), contracts.PIPELINE)), """
    select 'monthly_revenue' as table_name, x as test_name, 1 as tier, cast(0 as bigint) as failures, 'pass' as status
    from (values ('not_null_account_id'), ('not_null_revenue_month'), ('not_null_mrr_usd'), ('not_null_arr_usd'),
                 ('between_mrr_usd'), ('between_arr_usd'), ('unique_account_id_revenue_month'), ('schema_account_id'),
                 ('schema_revenue_month'), ('schema_mrr_usd'), ('schema_arr_usd')) t(x)
    where (select count(*) from m_revenue where cents < 0) = 0
    union all
    select 'pipeline_snapshot', x, 1, cast(n as bigint), case when n > 0 then 'fail' else 'pass' end
    from (values ('not_null_opportunity_id', 0), ('between_amount_usd', 0), ('unique_opportunity_id', 0),
                 ('schema_opportunity_id', 0), ('schema_snapshot_date', 0), ('schema_stage_name', 0),
                 ('schema_amount_usd', 0), ('schema_probability_pct', 0), ('schema_is_closed', 0),
                 ('schema_is_won', 1)) t(x, n)
    where (select count(*) from s_opportunity where amount_usd < 0) = 0""")


def _runs(c):
    """Job runs out of the access history: the queue time stands for the run time."""
    return c.raw["raw_access_history"].selectExpr(
        "cast(1 + cast(query_id as bigint) % 2 as int) as tier", "cast(start_time as date) as run_date",
        "cast(start_time as timestamp_ntz) + make_dt_interval(0, 0, 0, queued_ms * 8) as ended_at")


R.add("sla_hit_rate", lambda c: quality.sla_hit_rate(_runs(c), {1: "06:00:00", 2: "08:00:00"}), """
    with r as (select cast(1 + cast(query_id as bigint) % 2 as integer) as tier, cast(start_time as date) as run_date,
                      start_time + to_seconds(queued_ms * 8) as ended_at from raw_access_history),
    t as (select tier, count(*) as runs, count(*) filter (where ended_at <= run_date + case tier when 1
                 then interval 6 hour else interval 8 hour end) as on_time from r group by 1)
    select *, cast(on_time as double) / runs as sla_hit_rate from t""")
R.add("usage_cost", lambda c: quality.usage_cost(c.raw["raw_access_history"], "warehouse_name", "queued_ms",
                                                 F.col("objects_accessed").isNull()), """
    select warehouse_name, count(*) as requests, cast(sum(queued_ms) as bigint) as credits,
           count(*) filter (where objects_accessed is null) as errors,
           cast(count(*) filter (where objects_accessed is null) as double) / count(*) as error_rate
    from raw_access_history group by 1""")
R.add("queue_time", lambda c: quality.queue_time(c.raw["raw_access_history"], "2024-01-31 03:00:00"), """
    select warehouse_name, cast(sum(queued_ms) as double) / count(*) as avg_queue from raw_access_history
    where start_time >= timestamp '2024-01-30 23:00:00' group by 1 order by 2 desc""")
R.add("row_count_anomaly", lambda c: quality.row_count_anomaly(c.raw["raw_event"], "event_date", 7, 1.5).withColumns(
    {"sd_before": F.round("sd_before", 8), "z_score": F.round("z_score", 8)}), """
    with d as (select event_date as day, count(*) as row_count from raw_event group by 1),
    w as (select *, avg(row_count) over b as mean_before, stddev_samp(row_count) over b as sd_before from d
          window b as (order by day rows between 7 preceding and 1 preceding))
    select day, row_count, mean_before, round(sd_before, 8) as sd_before,
           round((row_count - mean_before) / nullif(sd_before, 0), 8) as z_score,
           coalesce(abs((row_count - mean_before) / nullif(sd_before, 0)) > 1.5, false) as is_anomaly from w""")

# --- history
FRAGMENTS.update({
    "h_standing": """
        select opportunity_id, changed_at, stage_name, amount from (
            select *, row_number() over (partition by opportunity_id, changed_at
                     order by version desc, stage_name desc, amount desc) as rn from raw_opportunity_history)
        where rn = 1""",
    "h_changed": """
        select * from (select *, lag(changed_at) over v is null as is_first, lag(stage_name) over v as p_stage,
                              lag(amount) over v as p_amount from h_standing
                       window v as (partition by opportunity_id order by changed_at))
        where is_first or stage_name is distinct from p_stage or amount is distinct from p_amount""",
    "h_scd2": """
        select opportunity_id, stage_name, amount, changed_at as valid_from,
               lead(changed_at) over (partition by opportunity_id order by changed_at) as valid_to
        from h_changed""",
})


def _scd2(c):
    return history.scd2_from_history(c.raw["raw_opportunity_history"], "opportunity_id", "changed_at",
                                     ["stage_name", "amount"], ["version"])


R.add("scd2_from_history", _scd2, """
    select opportunity_id, stage_name, cast(amount as double) as amount, valid_from, valid_to,
           valid_to is null as is_current from h_scd2""")


def _snapshot(c, before):
    rows = c.raw["raw_opportunity_history"].withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))
    return rows.filter(F.col("changed_at") < F.lit(before).cast("timestamp_ntz")).select(
        "opportunity_id", "stage_name", "amount", "changed_at")


def _merged(c):
    first = history.start_history(_snapshot(c, "1999-01-01"), "opportunity_id", "changed_at")
    deleted = c.raw["raw_opportunity"].filter("is_deleted").select(F.col("id").alias("opportunity_id"))
    batch = _snapshot(c, "2002-01-01").join(deleted, "opportunity_id", "left_anti")
    return history.scd2_merge(first, batch, "opportunity_id", "changed_at", "2002-01-02"), batch


def _merged_twice(c):
    once, batch = _merged(c)
    return history.scd2_merge(once, batch, "opportunity_id", "changed_at", "2002-01-02")


def _at(day: str) -> str:
    return f"""select opportunity_id, stage_name, amount, changed_at from (
        select *, row_number() over (partition by opportunity_id
                 order by changed_at desc, stage_name desc, amount desc) as rn
        from raw_opportunity_history where changed_at < timestamp '{day}') where rn = 1"""


_MERGE = f"""
    with o as ({_at('1999-01-01')}),
    b as (select * from ({_at('2002-01-01')}) where opportunity_id not in
          (select id from raw_opportunity where is_deleted)),
    m as (select o.*, o.changed_at as valid_from, case when b.opportunity_id is null then timestamp '2002-01-02'
                 when b.changed_at > o.changed_at then b.changed_at end as valid_to
          from o left join b on b.opportunity_id = o.opportunity_id
          union all
          select b.*, b.changed_at, null from b left join o on o.opportunity_id = b.opportunity_id
          where o.opportunity_id is null or b.changed_at > o.changed_at)
    select * replace (cast(amount as double) as amount), valid_to is null as is_current from m"""
R.add("scd2_merge", lambda c: _merged(c)[0], _MERGE)
R.add("scd2_merge_rerun", _merged_twice, _MERGE)


def _stored_history(c):
    """The same two snapshots merged in a stored history, the second one twice."""
    path = work_dir(c.spark, "keyed-history")
    keyed.create_history(_snapshot(c, "1999-01-01"), path, "opportunity_id", "changed_at", buckets=16)
    for _ in range(2):
        keyed.merge_history(_merged(c)[1], path, "changed_at", "2002-01-02", hard_deletes=True)
    return keyed.read_history(c.spark, path)


R.alike("merge_history", _stored_history, "scd2_merge")
R.add("as_of_lookup", lambda c: history.as_of_lookup(
    c.raw["raw_opportunity"].select(F.col("id").alias("opportunity_id"), "close_date"), _scd2(c),
    "opportunity_id", "close_date", ["stage_name", "amount"],
    hot=hot_keys(c.raw["raw_opportunity_history"], "opportunity_id")), """
    select o.id as opportunity_id, o.close_date, h.stage_name as valid_stage_name,
           cast(h.amount as double) as valid_amount, h.valid_from
    from raw_opportunity o left join h_scd2 h on h.opportunity_id = o.id
         and cast(o.close_date as timestamp) >= h.valid_from
         and (h.valid_to is null or cast(o.close_date as timestamp) < h.valid_to)""")
def _snapshots(c):
    """The table after a first run, a second one for the rest of the days, and the second one again."""
    path = work_dir(c.spark, "snapshots")
    rows = checkpointed(_scd2(c), "history")
    for end in ("2000-06-30", "2001-12-31", "2001-12-31"):
        history.append_daily_snapshots(rows, path, "1995-01-01", end, F.col("stage_name") != "AF")
    return history.read_daily_snapshots(c.spark, path, "opportunity_id string, stage_name string, amount decimal(18,2)",
                                        values.money_parts(F.col("amount"), "amount"), by=["stage_name"])


_SNAPSHOTS = """
    select cast(g as date) as snapshot_date, stage_name, count(*) as opportunities,
           cast(sum(amount) as double) as amount_usd
    from h_scd2 join generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day) t(g)
      on g >= valid_from and (valid_to is null or g < valid_to)
    where stage_name <> 'AF' group by 1, 2"""
R.add("daily_snapshot_append", lambda c: _snapshots(c).groupBy("snapshot_date", "stage_name").agg(
    F.coalesce(F.sum("versions"), F.lit(0)).alias("opportunities"),
    values.sum_of_money_parts("amount").alias("amount_usd")), _SNAPSHOTS)
R.add("snapshot_totals", lambda c: history.snapshot_totals(
    _scd2(c), "1995-01-01", "2001-12-31", ["stage_name"], ["amount"]), """
    select cast(g as date) as snapshot_date, stage_name, count(*) as versions, cast(sum(amount) as double) as amount
    from h_scd2 join generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day) t(g)
      on g >= valid_from and (valid_to is null or g < valid_to) group by 1, 2""")
R.add("attribute_change_log", lambda c: history.attribute_change_log(
    c.raw["raw_opportunity_history"].select("opportunity_id", "changed_at", "version", "stage_name", "amount"),
    "opportunity_id", "changed_at", "stage_name", ["version"]), """
    with s as (select opportunity_id, changed_at, stage_name from (
                 select *, row_number() over (partition by opportunity_id, changed_at
                          order by version desc, stage_name desc) as rn from raw_opportunity_history) where rn = 1),
    l as (select *, lag(stage_name) over (partition by opportunity_id order by changed_at) as old_value from s)
    select opportunity_id, old_value, stage_name as new_value, changed_at from l
    where old_value is not null and old_value <> stage_name""")
