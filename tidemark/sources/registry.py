"""The raw source tables: where they live, how they are read, how fresh they must be."""

from __future__ import annotations

import re

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """One raw table.  ``schema`` is a DDL string; None reads what the files declare."""

    system: str
    table: str
    schema: str | None = None
    warn_hours: float | None = None
    error_hours: float | None = None

    @property
    def key(self) -> str:
        return f"{self.system}.{self.table}"


_ACCOUNT = """id string, name string, industry string, type string, annual_revenue decimal(18,2),
    number_of_employees int, billing_country string, territory_id string, created_date timestamp,
    last_modified_date timestamp, is_deleted boolean, synced_at timestamp"""
_OPPORTUNITY = """id string, account_id string, name string, stage_name string, amount decimal(18,2),
    probability decimal(5,2), is_closed boolean, is_won boolean, close_date date, created_date timestamp,
    owner_id string, type string, lead_source string, is_deleted boolean, synced_at timestamp"""
_HISTORY = "opportunity_id string, version int, stage_name string, amount decimal(18,2), changed_at timestamp"
_CUSTOMER = "id string, email string, name string, metadata string, created timestamp, synced_at timestamp"
_SUBSCRIPTION = """id string, customer_id string, status string, plan_amount bigint, plan_interval string,
    current_period_start timestamp, current_period_end timestamp, canceled_at timestamp, created timestamp,
    synced_at timestamp"""
_CONTACT = """id string, property_email string, property_firstname string, property_lastname string,
    property_lifecyclestage string, property_hs_lead_status string, property_createdate timestamp,
    synced_at timestamp"""
_TRANSACTION = """id string, transaction_date date, account_type string, amount decimal(18,2), currency string,
    product_line string"""
_RATE = "currency string, rate_date date, rate decimal(9,4)"
_WORKER = """worker_id string, email string, first_name string, last_name string, phone string, department string,
    cost_center string, job_title string, employment_status string, hire_date date, termination_date date,
    fte decimal(4,2), salary decimal(18,2), manager_id string, synced_at timestamp"""
_REQUISITION = "id string, opened_date date, accepted_date date, department string"
_ENGAGEMENT = """activity_date date, account_id string, dau bigint, event_count bigint, sessions bigint,
    features_used array<string>"""

EVENT_SCHEMA = """event_id string, event_timestamp timestamp_ntz, event_name string, user_id string,
    account_id string, session_id string, platform string, event_params string, value double, event_date date"""

SOURCES: dict[str, Source] = {s.key: s for s in (
    Source("salesforce", "account", _ACCOUNT, 12, 24),
    Source("salesforce", "opportunity", _OPPORTUNITY, 12, 24),
    Source("salesforce", "user", None, 12, 24),
    Source("salesforce", "opportunity_history", _HISTORY, 12, 24),
    Source("stripe", "subscription", _SUBSCRIPTION, 12, 24),
    Source("stripe", "customer", _CUSTOMER, 12, 24),
    Source("stripe", "invoice", None, 12, 24),
    Source("stripe", "charge", None, 12, 24),
    Source("hubspot", "contact", _CONTACT),
    Source("hubspot", "deal"),
    Source("hubspot", "campaign"),
    Source("netsuite", "transaction", _TRANSACTION),
    Source("netsuite", "account"),
    Source("netsuite", "currency_rate", _RATE),
    Source("workday", "worker", _WORKER),
    Source("workday", "job_requisition", _REQUISITION),
    Source("product_events", "daily_engagement", _ENGAGEMENT),
)}


def resolve_namespace(env: str, layer: str) -> str:
    """Catalog prefix of a layer (``raw`` or ``analytics``) in an environment."""
    if layer not in ("raw", "analytics"):
        raise ValueError(f"unknown layer {layer!r}")
    return f"{layer}_{env.lower()}"


def read_source(spark: SparkSession, root: str, key: str, env: str = "prod") -> DataFrame:
    """Read one registered raw table below ``root`` with its declared schema."""
    if key not in SOURCES:
        raise ValueError(f"unknown source {key!r}")
    source = SOURCES[key]
    path = f"{root.rstrip('/')}/{resolve_namespace(env, 'raw')}/{source.system}/{source.table}"
    reader = spark.read
    if source.schema:
        return reader.schema(source.schema).parquet(path)
    return reader.option("mergeSchema", "true").parquet(path)


def read_relation(spark: SparkSession, relation: str) -> DataFrame:
    """A table by name, or the result of a query."""
    text = relation.strip()
    query = re.match(r"(select|with|from|values|table)\b|\(", text, re.IGNORECASE)
    return spark.sql(text) if query else spark.table(text)


def external_table(spark: SparkSession, name: str, path: str, schema: str) -> DataFrame:
    """Register parquet in place as a session view and return it."""
    spark.read.schema(schema).parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """A layer's node as a view, or as a written table that is read back."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        if path is None:
            raise ValueError("a table needs a path")
        df.write.mode("overwrite").parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        table.createOrReplaceTempView(name)
        return table
    raise ValueError(f"unknown kind {kind!r}")
