"""The given parquet tables shaped like the raw source tables (see FIXTURES.md).

The expressions are portable: the same text shapes the input for Spark and for DuckDB.
Arithmetic on the keys plants the traps listed there (deleted rows, second billing
customers, missing firmographics); it never thins a table to make a query cheaper.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF_ORDERS = "2001-08-01"
AS_OF_EVENTS = "2024-01-31"
SPINE_START = "1995-01-01"
TEST_ACCOUNTS = ("11", "22")

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


@dataclass(frozen=True)
class Binding:
    tables: tuple[str, ...]
    columns: dict[str, str]
    on: str | None = None
    where: str | None = None
    distinct: dict[str, str] | None = None
    each: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def sql(self) -> str:
        picked = ", ".join(f"{e} as {n}" for n, e in self.columns.items())
        source = f" join ".join(self.tables) + (f" on {self.on}" if self.on else "")
        if self.distinct:
            source = "(select distinct " + ", ".join(f"{e} as {n}" for n, e in self.distinct.items()) + \
                     f" from {source}) d"
        for name, values in self.each.items():
            listed = " union all ".join(f"select '{v}' as {name}" for v in values)
            source += f" cross join ({listed}) c"
        return f"select {picked} from {source}" + (f" where {self.where}" if self.where else "")


def _months_of(column: str) -> str:
    return f"date_trunc('month', {column})"


_CHANNEL = ("case o_orderkey % 4 when 0 then 'paid_search' when 1 then 'paid_social' "
            "when 2 then 'email' else 'organic' end")
_BILLING = {
    "id": "'cus_' || cast(c_custkey as string)",
    "email": "'user' || cast(c_custkey as string) || '@example.com'",
    "name": "c_name",
    "metadata": "case when c_custkey % 10 = 9 then '{}' else "
                "'{\"account_id\":\"' || cast(c_custkey as string) || '\"}' end",
    "created": "cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp)",
    "synced_at": "cast(date '2001-08-01' - cast(c_custkey % 3 as int) as timestamp)",
}

BINDINGS: dict[str, Binding] = {
    "raw_account": Binding(("customer", "nation"), {
        "id": "cast(c_custkey as string)",
        "name": "c_name",
        "industry": "c_mktsegment",
        "type": "case when c_custkey % 3 = 0 then 'Partner' else 'Customer' end",
        "annual_revenue": "cast(c_acctbal * 1000 as decimal(18,2))",
        "number_of_employees": "cast(c_custkey % 500 as int)",
        "billing_country": "n_name",
        "territory_id": "cast(c_nationkey as string)",
        "created_date": "cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp)",
        "last_modified_date": "cast(date '2001-08-01' - cast(c_custkey % 30 as int) as timestamp)",
        "is_deleted": "case when c_custkey % 89 = 5 then null when c_custkey % 97 = 3 then true else false end",
        "synced_at": "cast(date '2001-08-01' - cast(c_custkey % 3 as int) as timestamp)",
    }, on="c_nationkey = n_nationkey"),
    "raw_opportunity": Binding(("orders",), {
        "id": "cast(o_orderkey as string)",
        "account_id": "cast(o_custkey as string)",
        "name": "'Opp ' || cast(o_orderkey as string)",
        "stage_name": "o_orderpriority",
        "amount": "cast(o_totalprice as decimal(18,2))",
        "probability": "cast(case o_orderpriority when '1-URGENT' then 90 when '2-HIGH' then 70 "
                       "when '3-MEDIUM' then 50 when '4-NOT SPECIFIED' then 30 else 10 end as decimal(5,2))",
        "is_closed": "o_orderstatus <> 'O'",
        "is_won": "o_orderstatus = 'F'",
        "close_date": "cast(o_orderdate as date)",
        "created_date": "cast(cast(o_orderdate as date) - cast(o_orderkey % 120 as int) as timestamp)",
        "owner_id": "cast(o_custkey % 50 as string)",
        "type": "case when o_orderkey % 2 = 0 then 'New' else 'Renewal' end",
        "lead_source": _CHANNEL,
        "is_deleted": "o_orderkey % 101 = 7",
        "synced_at": "cast(date '2001-08-01' - cast(o_orderkey % 3 as int) as timestamp)",
    }),
    "raw_opportunity_history": Binding(("lineitem",), {
        "opportunity_id": "cast(l_orderkey as string)",
        "version": "l_linenumber",
        "stage_name": "l_returnflag || l_linestatus",
        "amount": "cast(l_extendedprice as decimal(18,2))",
        "changed_at": "cast(l_shipdate as timestamp)",
    }),
    "raw_billing_customer_1": Binding(("customer",), _BILLING),
    "raw_billing_customer_2": Binding(("customer",), {
        "id": "'cus_' || cast(c_custkey as string) || 'b'",
        "email": "'user' || cast(c_custkey as string) || 'b@example.com'",
        "name": "c_name",
        "metadata": "'{\"account_id\":\"' || cast(c_custkey as string) || '\"}'",
        "created": "cast(date '1996-01-01' as timestamp)",
        "synced_at": "cast(date '2001-08-01' - cast(c_custkey % 3 as int) as timestamp)",
    }, where="c_custkey % 7 = 0"),
    "raw_subscription": Binding(("orders",), {
        "id": "'sub_' || cast(o_orderkey as string)",
        "customer_id": "'cus_' || cast(o_custkey as string) || "
                       "case when o_custkey % 7 = 0 and o_orderkey % 2 = 0 then 'b' else '' end",
        "status": "case o_orderkey % 6 when 0 then 'active' when 1 then 'trialing' when 2 then 'past_due' "
                  "when 3 then 'canceled' when 4 then 'unpaid' else 'active' end",
        "plan_amount": "cast(round(o_totalprice * 100) as bigint)",
        "plan_interval": "case o_orderpriority when '3-MEDIUM' then 'year' when '5-LOW' then 'week' else 'month' end",
        "current_period_start": "cast(o_orderdate as timestamp)",
        "current_period_end": "cast(cast(o_orderdate as date) + "
                              "case when o_orderpriority = '3-MEDIUM' then 365 else 30 end as timestamp)",
        "canceled_at": "case when o_orderstatus = 'P' then "
                       "cast(cast(o_orderdate as date) + cast(o_orderkey % 60 as int) as timestamp) end",
        "created": "cast(o_orderdate as timestamp)",
        "synced_at": "cast(date '2001-08-01' - cast(o_orderkey % 3 as int) as timestamp)",
    }),
    "raw_transaction": Binding(("lineitem",), {
        "id": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
        "transaction_date": "cast(l_shipdate as date)",
        "account_type": "case l_returnflag when 'N' then 'Income' when 'R' then 'COGS' else 'Other' end",
        "amount": "cast(l_extendedprice as decimal(18,2))",
        "currency": "case l_suppkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'GBP' end",
        "product_line": "cast(l_partkey % 5 as string)",
    }),
    "raw_account_transaction": Binding(("lineitem", "orders"), {
        "account_id": "cast(o_custkey as string)",
        "transaction_date": "cast(l_shipdate as date)",
        "account_type": "case l_returnflag when 'N' then 'Income' when 'R' then 'COGS' else 'Other' end",
        "amount": "cast(l_extendedprice as decimal(18,2))",
        "product_line": "cast(l_partkey % 5 as string)",
    }, on="l_orderkey = o_orderkey"),
    "raw_currency_rate": Binding(("orders",), {
        "currency": "cur",
        "rate_date": "cast(o_orderdate as date)",
        "rate": "cast(case when cur = 'USD' then 1 else 1 + (month(o_orderdate) % 5) / 100.0 end as decimal(9,4))",
    }, distinct={"o_orderdate": _months_of("o_orderdate")}, each={"cur": ("USD", "EUR", "GBP")}),
    "raw_contact": Binding(("orders",), {
        "id": "cast(o_orderkey as string)",
        "property_email": "'user' || cast(o_custkey as string) || '@example.com'",
        "property_firstname": "'F' || cast(o_custkey as string)",
        "property_lastname": "'L' || cast(o_orderkey % 100 as string)",
        "property_lifecyclestage": "case o_orderpriority when '1-URGENT' then 'marketingqualifiedlead' "
                                   "when '2-HIGH' then 'salesqualifiedlead' when '3-MEDIUM' then 'lead' "
                                   "when '4-NOT SPECIFIED' then 'subscriber' else 'opportunity' end",
        "property_hs_lead_status": "o_orderstatus",
        "property_createdate": "cast(o_orderdate as timestamp)",
        "synced_at": "cast(date '2001-08-01' - cast(o_orderkey % 3 as int) as timestamp)",
    }),
    "raw_ad_spend": Binding(("orders",), {
        "activity_date": "cast(o_orderdate as date)",
        "channel": _CHANNEL,
        "campaign_id": "'c' || cast(o_orderkey % 12 as string)",
        "spend_usd": "cast(o_orderkey % 5000 as decimal(18,2))",
        "impressions": "cast(o_orderkey % 1000 as bigint)",
        "clicks": "cast(o_orderkey % 37 as bigint)",
    }),
    "raw_campaign": Binding(("orders",), {
        "campaign_id": "'c' || cast(n as string)",
        "campaign_name": "'Campaign ' || cast(n as string)",
        "channel": "case n % 4 when 0 then 'paid_search' when 1 then 'paid_social' when 2 then 'email' else 'organic' end",
    }, distinct={"n": "o_orderkey % 12"}),
    "raw_touch": Binding(("lineitem",), {
        "touch_id": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
                    "cast(l_partkey as string) || '-' || cast(l_suppkey as string)",
        "opportunity_id": "cast(l_orderkey as string)",
        "campaign_id": "'c' || cast(l_partkey % 12 as string)",
        "touched_at": "cast(l_shipdate as timestamp)",
    }),
    "raw_worker": Binding(("supplier", "nation"), {
        "worker_id": "'emp_' || cast(s_suppkey as string)",
        "email": "'emp' || cast(s_suppkey as string) || '@example.com'",
        "first_name": "'F' || cast(s_suppkey as string)",
        "last_name": "s_name",
        "phone": "'555-010-' || cast(1000 + s_suppkey % 9000 as string)",
        "department": "n_name",
        "cost_center": "'cc' || cast(s_nationkey as string)",
        "job_title": "case when s_suppkey % 8 = 0 then 'Manager' else 'Analyst' end",
        "employment_status": "case when s_suppkey % 4 = 0 then 'Terminated' else 'Active' end",
        "hire_date": "date '1995-01-01' + cast((s_suppkey * 37) % 2300 as int)",
        "termination_date": "case when s_suppkey % 20 = 0 then date '2001-08-01' - cast(s_suppkey % 25 as int) "
                            "when s_suppkey % 4 = 0 then date '1995-01-01' + "
                            "cast((s_suppkey * 37) % 2300 + 150 + s_suppkey % 300 as int) end",
        "fte": "cast(case when s_suppkey % 5 = 0 then 0.5 else 1 end as decimal(4,2))",
        "salary": "cast(40000 + (s_suppkey * 131) % 60000 as decimal(18,2))",
        "manager_id": "case when s_suppkey >= 8 then 'emp_' || cast(s_suppkey - s_suppkey % 8 - 8 as string) end",
        "synced_at": "cast(date '2001-08-01' - cast(s_suppkey % 3 as int) as timestamp)",
    }, on="s_nationkey = n_nationkey"),
    "raw_requisition": Binding(("part",), {
        "id": "cast(p_partkey as string)",
        "opened_date": "date '2000-01-01' + cast(p_partkey % 500 as int)",
        "accepted_date": "case when p_partkey % 5 <> 0 then "
                         "date '2000-01-01' + cast(p_partkey % 500 + p_size as int) end",
        "department": "p_brand",
    }),
    "raw_event": Binding(("events",), {
        "event_id": "cast(event_id as string)",
        "event_timestamp": "ts",
        "event_date": "cast(ts as date)",
        "event_name": "case when event_type = 'signup' then 'session_start' else event_type end",
        "user_id": "cast(user_id as string)",
        "account_id": "case when user_id % 40 = 39 then null else cast(user_id % 50 as string) end",
        "session_id": "cast(user_id as string) || '-' || cast(cast(ts as date) as string)",
        "platform": "case event_id % 3 when 0 then 'web' when 1 then 'ios' else 'android' end",
        "event_params": "props",
        "value": "value",
    }),
    "raw_user_territory": Binding(("nation",), {
        "user_email": "'rep' || cast(n_regionkey as string) || '@example.com'",
        "territory_id": "cast(n_nationkey as string)",
    }),
    "raw_access_history": Binding(("pages",), {
        "query_id": "cast(page_id as string)",
        "user_name": "'user' || cast(page_id % 20 as string)",
        "warehouse_name": "case page_id % 3 when 0 then 'etl' when 1 then 'bi' else 'adhoc' end",
        "query_text": "html",
        "objects_accessed": "case when page_id % 9 <> 0 then url end",
        "start_time": "cast(date '2024-01-31' - cast(page_id % 4 as int) as timestamp)",
        "queued_ms": "page_id * 7 % 5000",
    }),
    "raw_firmographic": Binding(("customer",), {
        "account_id": "cast(c_custkey as string)",
        "employee_count_band": "case when c_custkey % 2 = 0 then '1-50' else '51-200' end",
        "industry_json": "'{\"code\":\"' || c_mktsegment || '\"}'",
        "technologies_csv": "case when c_custkey % 3 = 0 then null else 'a,b' end",
    }, where="c_custkey % 5 <> 0"),
    "raw_quota": Binding(("orders",), {
        "owner_id": "cast(o_custkey as string)",
        "quarter_start": "cast(o_orderdate as date)",
        "quota_usd": "cast(2500000 as decimal(18,2))",
    }, distinct={"o_custkey": "o_custkey % 50", "o_orderdate": "date_trunc('quarter', o_orderdate)"}),
}


class RawTables:
    """Raw source tables over one folder of the given parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._known: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        if table not in self._known:
            self._known[table] = self.spark.read.schema(TABLES[table]).parquet(f"{self.sf_dir}/{table}.parquet")
        return self._known[table]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._bound(name)
        return self._known[name]

    def _bound(self, name: str) -> DataFrame:
        if name == "raw_billing_customer":
            return self["raw_billing_customer_1"].unionByName(self["raw_billing_customer_2"])
        binding = BINDINGS[name]
        df = self.base(binding.tables[0])
        for other in binding.tables[1:]:
            df = df.join(self.base(other), F.expr(binding.on))
        if binding.distinct:
            df = df.selectExpr(*[f"{e} as {n}" for n, e in binding.distinct.items()]).distinct()
        for column, values in binding.each.items():
            df = df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
        if binding.where:
            df = df.filter(binding.where)
        return df.selectExpr(*[f"{e} as {n}" for n, e in binding.columns.items()])
