"""Source, landing and load queries.  Written tables go to the shared work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import identity
from tidemark.plans import incremental
from tidemark.session import work_dir
from tidemark.sources import keyed, landing, registry
from workload.bindings import AS_OF_EVENTS, AS_OF_ORDERS
from workload.context import EVENTS_FROM, Registry

R = Registry()
LOADED = "2001-08-02 01:30:00"


def _registered(c):
    root = work_dir(c.spark, "raw")
    c.raw["raw_subscription"].write.parquet(f"{root}/raw_prod/stripe/subscription")
    return registry.read_source(c.spark, root, "stripe.subscription")


R.add("read_source", _registered, "select * from raw_subscription")


def _land(c):
    path = work_dir(c.spark, "landing")
    landing.land_partition(c.raw["raw_opportunity"].select("id", "amount", "close_date"), path, AS_OF_ORDERS, LOADED)
    return path


R.add("land_partition", lambda c: landing.complete_partitions(c.spark, _land(c)), f"""
    select id, cast(amount as double) as amount, close_date, date '{AS_OF_ORDERS}' as _extract_date,
           timestamp '{LOADED}' as _loaded_at, date '{AS_OF_ORDERS}' as dt from raw_opportunity""")


def _incomplete(c):
    path = _land(c)
    unfinished = landing.stamp(c.raw["raw_opportunity"].select("id", "amount", "close_date"), "2001-08-02", LOADED)
    landing.balanced(unfinished, "dt").write.mode("append").partitionBy("dt").parquet(f"{path}/data")
    return landing.complete_partitions(c.spark, path)


R.add("complete_partitions", _incomplete, f"""
    select id, cast(amount as double) as amount, close_date, date '{AS_OF_ORDERS}' as _extract_date,
           timestamp '{LOADED}' as _loaded_at, date '{AS_OF_ORDERS}' as dt from raw_opportunity""")


def _event_files(c):
    path = work_dir(c.spark, "events")
    landing.write_events(c.raw["raw_event"], f"{path}/data")
    return path


def _manifest(c):
    path = work_dir(c.spark, "events")
    rows = c.raw["raw_event"].withColumn("dt", F.col("event_date"))
    landing.balanced(rows, "dt").write.partitionBy("dt").parquet(f"{path}/data")
    days = rows.agg(F.explode(F.sequence(F.min("dt"), F.date_add(F.max("dt"), 3))).alias("dt"))
    found = landing.landing_manifest(c.spark, path, days)
    # How many files a day becomes is the writer's choice; that there are some is not.
    return found.withColumn("files_found", F.col("files_found") > 0)


R.add("landing_manifest", _manifest, """
    select cast(g as date) as dt, count(event_id) as rows_found, count(event_id) = 0 as is_empty,
           count(event_id) > 0 as files_found
    from generate_series((select cast(min(event_date) as timestamp) from raw_event),
                         (select cast(max(event_date) as timestamp) from raw_event) + interval 3 day,
                         interval 1 day) t(g)
    left join raw_event on event_date = cast(g as date) group by 1""")
R.add("copy_into", lambda c: landing.copy_into(
    c.raw["raw_account"].select(F.col("id").alias("ID"), F.col("name").alias("Name"),
                                F.col("number_of_employees").cast("string").alias("Employees")),
    "id string, name string, employees bigint, region string"), """
    select id, name, cast(number_of_employees as bigint) as employees, cast(null as varchar) as region
    from raw_account""")


def _copy_once(c):
    path = _event_files(c)
    stored = c.spark.read.schema(registry.EVENT_SCHEMA).parquet(f"{path}/data").select(
        "event_id", "event_date", F.col("_metadata.file_path").alias("file_path"))
    # Everything of the first half of January counts as loaded before.
    loaded = stored.filter("event_date < date '2024-01-16'").select("file_path").distinct()
    return landing.copy_once(stored, loaded).drop("file_path")


R.add("copy_once", _copy_once, "select event_id, event_date from raw_event where event_date >= date '2024-01-16'")
R.add("merge_upsert", lambda c: landing.merge_upsert(
    c.raw["raw_opportunity"].select("id", "stage_name", "amount", F.col("created_date").alias("updated_at")),
    c.raw["raw_opportunity_history"].select(F.col("opportunity_id").alias("id"), "stage_name", "amount",
                                            F.col("changed_at").alias("updated_at")), ["id"], "updated_at"), """
    with u as (select id, stage_name, amount, created_date as updated_at, 0 as n from raw_opportunity
               union all select opportunity_id, stage_name, amount, changed_at, 1 from raw_opportunity_history)
    select id, stage_name, cast(amount as double) as amount, updated_at from (
        select *, row_number() over (partition by id order by updated_at desc, n desc, stage_name desc, amount desc)
               as rn from u) where rn = 1""")
R.add("merge_upsert_null_keys", lambda c: landing.merge_upsert(
    c.raw["raw_opportunity"].select(F.when(F.col("is_won"), F.col("id")).alias("id"), "stage_name",
                                    F.col("created_date").alias("updated_at")),
    c.raw["raw_opportunity"].select(F.when(~F.col("is_won"), F.col("id")).alias("id"), "stage_name",
                                    F.col("created_date").alias("updated_at")), ["id"], "updated_at"), """
    select case when is_won then id end as id, stage_name, created_date as updated_at from raw_opportunity
    union all select case when not is_won then id end, stage_name, created_date from raw_opportunity""")
R.add("backfill_rows", lambda c: landing.backfill_rows(
    c.raw["raw_event"].select("event_id", "event_date"), "event_date", "2024-01-05", "2024-01-20"), """
    select event_id, event_date from raw_event where event_date between date '2024-01-05' and date '2024-01-20'""")


def _backfill(c):
    path = work_dir(c.spark, "backfill")
    rows = c.raw["raw_event"].select("event_id", "event_date", F.lit(1).alias("revision"))
    landing.balanced(rows, "event_date").write.partitionBy("event_date").parquet(path)
    landing.backfill(rows.withColumn("revision", F.lit(2)), "event_date", path, "2024-01-05", "2024-01-20")
    return c.spark.read.schema("event_id string, revision int, event_date date").parquet(path)


R.add("backfill", _backfill, """
    select event_id, event_date, case when event_date between date '2024-01-05' and date '2024-01-20' then 2 else 1 end
           as revision from raw_event""")
def _backfill_emptied(c):
    path = work_dir(c.spark, "backfill")
    rows = c.raw["raw_event"].select("event_id", "event_date", F.lit(1).alias("revision"))
    landing.balanced(rows, "event_date").write.partitionBy("event_date").parquet(path)
    again = rows.withColumn("revision", F.lit(2)).filter("event_date <> date '2024-01-10'")
    landing.backfill(again, "event_date", path, "2024-01-05", "2024-01-20")
    return c.spark.read.schema("event_id string, revision int, event_date date").parquet(path)


R.add("backfill_emptied_day", _backfill_emptied, """
    select event_id, event_date, case when event_date between date '2024-01-05' and date '2024-01-20' then 2 else 1 end
           as revision from raw_event where event_date <> date '2024-01-10'""")


def _landed_again(c, rows):
    path = work_dir(c.spark, "landing")
    events = c.raw["raw_event"].select("event_id", "event_name")
    landing.land_partition(events, path, "2024-01-01", LOADED)
    landing.land_partition(events, path, "2024-01-02", LOADED)
    landing.land_partition(events.filter(rows), path, "2024-01-02", LOADED)
    return landing.complete_partitions(c.spark, path).select("event_id", "event_name", "dt")


R.add("land_partition_again", lambda c: _landed_again(c, "event_name = 'click'"), """
    select event_id, event_name, date '2024-01-01' as dt from raw_event
    union all select event_id, event_name, date '2024-01-02' from raw_event where event_name = 'click'""")
R.add("land_partition_emptied", lambda c: _landed_again(c, "false"),
      "select event_id, event_name, date '2024-01-01' as dt from raw_event")
R.add("schema_drift", lambda c: landing.schema_drift_report(
    c.raw["raw_worker"].select("worker_id", "department", "fte", "salary"),
    c.raw["raw_worker"].select("worker_id", "department", F.col("hire_date").cast("string").alias("fte"),
                               "termination_date")), """
    select 'termination_date' as column_name, 'added' as change, cast(null as varchar) as expected_type,
           'date' as actual_type, false as blocks, count(termination_date) as filled_values,
           cast(0 as bigint) as uncastable_values from raw_worker
    union all select 'salary', 'removed', 'decimal(18,2)', null, true, 0, 0
    union all select 'fte', 'type_changed', 'decimal(4,2)', 'string', true, count(hire_date), count(hire_date)
              from raw_worker""")


def _relation(c):
    c.raw["raw_transaction"].createOrReplaceTempView("tidemark_transaction")
    return registry.read_relation(c.spark, """
        select account_type, count(*) as n, sum(amount) as amount from tidemark_transaction group by account_type""")


R.add("read_relation", _relation, """
    select account_type, count(*) as n, cast(sum(amount) as double) as amount from raw_transaction group by 1""")


def _overwritten(c):
    path = work_dir(c.spark, "table")
    landing.overwrite_table(c.raw["raw_contact"].select("id", "property_email"), path)
    landing.overwrite_table(c.raw["raw_worker"].select(F.col("worker_id").alias("id"), "email"), path)
    return c.spark.read.schema("id string, email string").parquet(path)


R.add("overwrite_table", _overwritten, "select worker_id as id, email from raw_worker")


def _exported(c):
    path = work_dir(c.spark, "export")
    days = c.marts.account_engagement.select("activity_date", "account_id", "dau", "event_count")
    landing.export_partition(days, "activity_date", "2024-01-15", path)
    return c.spark.read.schema("activity_date date, account_id string, dau bigint, event_count bigint, dt date"
                               ).parquet(path)


R.add("export_partition", _exported, """
    select activity_date, account_id, dau, event_count, activity_date as dt from m_real_engagement
    where activity_date = date '2024-01-15'""")
def _exported_empty(c):
    path = work_dir(c.spark, "export")
    days = c.raw["raw_event"].select("event_id", "event_date")
    for source in (days, days.filter("event_date <> date '2024-01-15'")):
        for one in ("2024-01-14", "2024-01-15"):
            landing.export_partition(source, "event_date", one, path)
    return c.spark.read.schema("event_id string, event_date date, dt date").parquet(path)


R.add("export_partition_emptied", _exported_empty, """
    select event_id, event_date, event_date as dt from raw_event where event_date = date '2024-01-14'""")
R.add("external_table", lambda c: registry.external_table(
    c.spark, "tidemark_supplier", f"{c.sf_dir}/supplier.parquet", "s_suppkey bigint, s_name string, s_acctbal double"),
    "select s_suppkey, s_name, s_acctbal from supplier")
R.add("write_events", lambda c: c.spark.read.schema(registry.EVENT_SCHEMA).parquet(f"{_event_files(c)}/data"),
      "select * from raw_event")
R.add("require_partition_filter", lambda c: landing.read_events(
    c.spark, f"{_event_files(c)}/data", registry.EVENT_SCHEMA, EVENTS_FROM, AS_OF_EVENTS).select(
    "event_id", "event_date", "event_name"), "select event_id, event_date, event_name from raw_event")


def _materialized(c):
    return registry.materialize(c.marts.gross_margin, "table", "tidemark_margin", work_dir(c.spark, "margin"))


R.add("materialize", _materialized, """
    select revenue_month, cast(revenue_usd as double) as revenue_usd, cast(cogs_usd as double) as cogs_usd,
           cast(revenue_usd - cogs_usd as double) as gross_profit_usd,
           cast(revenue_usd - cogs_usd as double) / nullif(cast(revenue_usd as double), 0) as gross_margin_pct
    from m_margin""")
_RULES = {"label": "int", "amount": "decimal(9,2)"}


def _dirty(c):
    """Part names stand where numbers are expected; large amounts do not fit."""
    return c.raw["raw_opportunity"].select(
        "id", F.when(F.col("is_won"), F.col("stage_name")).otherwise(F.col("owner_id")).alias("label"),
        (F.col("amount") * 50).cast("string").alias("amount"))


_QUARANTINE = """
    d as (select id, case when is_won then stage_name else owner_id end as label,
                 cast(amount * 50 as varchar) as amount from raw_opportunity),
    q as (select *, try_cast(label as integer) is null as bad_label, try_cast(amount as decimal(9,2)) is null as bad_amount
          from d)"""
R.add("quarantine_accepted", lambda c: landing.quarantine(_dirty(c), _RULES)[0], f"""
    with {_QUARANTINE} select id, cast(label as integer) as label, cast(cast(amount as decimal(9,2)) as double) as amount
    from q where not bad_label and not bad_amount""")
R.add("quarantine_errors", lambda c: landing.quarantine(_dirty(c), _RULES)[1], f"""
    with {_QUARANTINE} select id, label, amount, concat_ws(',', case when bad_label then 'label is not int' end,
        case when bad_amount then 'amount is not decimal(9,2)' end) as reasons from q where bad_label or bad_amount""")

# --- identity and enrichment
_LINKS = """
    b as (select c.customer_id, c.salesforce_account_id as account_id, lower(trim(c.email)) as email, c.created_at
          from s_customer c join s_account a on a.account_id = c.salesforce_account_id),
    o as (select email, account_id from (select *, row_number() over (partition by email
               order by created_at desc, customer_id desc) as rn from b) where rn = 1),
    links as (select account_id, 'crm' as system, account_id as external_id from s_account
              union select account_id, 'billing', customer_id from b
              union select o.account_id, 'marketing', k.contact_id from s_contact k join o on o.email = lower(trim(k.email))
              union select e.account_id, 'product', e.user_id from raw_event e join s_account a
                    on a.account_id = e.account_id)"""


def _links(c):
    return identity.identity_links(c.marts.accounts, c.marts.customers, c.marts.contacts, c.raw["raw_event"],
                                   EVENTS_FROM, AS_OF_EVENTS)


R.add("identity_links", _links, f"with {_LINKS} select * from links")
R.add("identity_spine", lambda c: identity.identity_spine(_links(c)), f"""
    with {_LINKS} select account_id, """ + ", ".join(
    f"count(*) filter (where system = '{s}') as {s}_ids, min(external_id) filter (where system = '{s}') as {s}_id"
    for s in identity.SYSTEMS) + " from links group by 1")

# Four customers in a row write from one company's domain, every ninth from a domain that many share.
_N = "cast(regexp_extract(email, '[0-9]+', 0) as bigint)"
_COMPANY = (f"case when {_N} % 9 = 0 then email else split_part(email, '@', 1) || '@c' || "
            f"cast(cast(floor({_N} / 4) as bigint) as string) || '.example' end")


def _components(c):
    customers, contacts = (df.withColumn("email", F.expr(_COMPANY)) for df in (c.marts.customers, c.marts.contacts))
    records = identity.identity_records(c.marts.accounts, customers, contacts, c.raw["raw_event"], EVENTS_FROM, AS_OF_EVENTS)
    return identity.identity_components(records, [*identity.SHARED_DOMAINS, "example.com"])


# Labels sink to the least one of a record's neighbours, step by step; the links above need fewer steps than these.
_REACHED = f"""(with recursive
    r as (select 'crm' as system, account_id as external_id, null as email, account_id from s_account
          union all select 'billing', customer_id, {_COMPANY}, salesforce_account_id from s_customer
          union all select 'marketing', contact_id, {_COMPANY}, null from s_contact
          union all select distinct 'product', user_id, null, account_id from raw_event),
    k as (select *, system || ':' || external_id as rec,
                 case when split_part(email, '@', 2) <> 'example.com' then split_part(email, '@', 2) end as dom from r),
    p as (select *, rec as label, 0 as step from k
          union all
          select system, external_id, email, account_id, rec, dom, least(label,
                 min(label) over (partition by rec),
                 case when email is not null then min(label) over (partition by email) end,
                 case when dom is not null then min(label) over (partition by dom) end,
                 case when account_id is not null then min(label) over (partition by account_id) end), step + 1
          from p where step < 16)
    select distinct system, external_id, label as identity_id from p where step = 16)"""
R.add("identity_components", _components, f"select * from {_REACHED} x")
R.add("identity_sizes", lambda c: identity.identity_sizes(_components(c)), "select identity_id, " + ", ".join(
    f"count(*) filter (where system = '{s}') as {s}_ids" for s in identity.SYSTEMS) + f""",
    count(*) filter (where system = 'crm') > 1 as several_accounts from {_REACHED} x group by 1""")
R.add("enrich_accounts", lambda c: identity.enrich_accounts(c.marts.accounts, c.raw["raw_firmographic"].select(
    "account_id", "employee_count_band", F.from_json("industry_json", "code string").alias("industry"),
    F.split("technologies_csv", ",").alias("technologies"))), """
    select account_id, employee_count_band, json_extract_string(industry_json, '$.code') as industry_code,
           coalesce(technologies_csv, '') as tech_stack
    from s_account join raw_firmographic using (account_id)""")


def _merged_into(c):
    """Opportunities by key bucket; then, day by day as they arrive, the changes of one year and those of all others."""
    path = work_dir(c.spark, "keyed")
    keyed.create_keyed(c.raw["raw_opportunity"].select("id", "stage_name", "amount", F.col("created_date").alias("updated_at")),
                       path, ["id"], buckets=16)
    changes = c.raw["raw_opportunity_history"].select(F.col("opportunity_id").alias("id"), "stage_name", "amount",
                                                      F.col("changed_at").alias("updated_at"))
    late = F.year("updated_at") == 1996
    for batch in (changes.filter(~late), changes.filter(late), changes.filter(late), changes.filter("false")):
        keyed.merge_into(batch, path, "updated_at")
    return keyed.read_keyed(c.spark, path)


R.alike("merge_into", _merged_into, "merge_upsert")


def _kept_up(c):
    """The engagement mart after a first build and four refreshes: two later loads, one of late events, one load repeated
    in full after half of it had arrived."""
    landed, mart = work_dir(c.spark, "landing"), work_dir(c.spark, "mart")
    late = F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0
    events = c.raw["raw_event"].withColumn("load", F.expr("""case when event_date <= date '2024-01-10' then '2024-01-10'
        when event_date <= date '2024-01-20' then '2024-01-20' else '2024-01-31' end"""))

    def land(load, rows, at):
        landing.land_partition(rows.drop("load"), landed, load, at)
        incremental.refresh(c.spark, landed, mart, incremental.ENGAGEMENT, "week")

    in_time = events.filter(~late)
    land("2024-01-10", in_time.filter("load = '2024-01-10'"), "2024-01-11 01:00:00")
    land("2024-01-20", in_time.filter("load = '2024-01-20' and event_name <> 'click'"), "2024-01-21 01:00:00")
    land("2024-01-31", in_time.filter("load = '2024-01-31'"), "2024-02-01 01:00:00")
    land("2024-01-20", in_time.filter("load = '2024-01-20'"), "2024-02-02 01:00:00")
    land("2024-02-05", events.filter(late), "2024-02-06 01:00:00")
    return incremental.read_mart(c.spark, mart)


R.add("incremental_mart", _kept_up, "select * from m_engagement")
