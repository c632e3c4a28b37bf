"""Staging projections: rename, cast and filter, one raw table each.

They stay narrow and lazy, so column pruning and filters collapse into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.values import cents_to_dollars, json_field
from tidemark.operators.relational import drop_soft_deleted, exclude_ids, rename_cast

WALL = "timestamp_ntz"


def stg_accounts(raw: DataFrame, test_ids: Sequence[str] | DataFrame = (), synced: str = "synced_at",
                 deleted_flag: str = "is_deleted") -> DataFrame:
    live = drop_soft_deleted(raw, deleted_flag)
    renamed = rename_cast(live, {
        "account_id": "id",
        "account_name": "name",
        "industry": "industry",
        "account_type": "type",
        "annual_revenue": "annual_revenue",
        "number_of_employees": "number_of_employees",
        "billing_country": "billing_country",
        "created_at": ("created_date", WALL),
        "updated_at": ("last_modified_date", WALL),
        "is_deleted": deleted_flag,
        "loaded_at": synced,
    })
    return exclude_ids(renamed, "account_id", test_ids)


def dim_accounts(accounts: DataFrame) -> DataFrame:
    """The account dimension is the staged account, unchanged."""
    return accounts


def stg_opportunities(raw: DataFrame, synced: str = "synced_at",
                      deleted_flag: str = "is_deleted") -> DataFrame:
    return rename_cast(drop_soft_deleted(raw, deleted_flag), {
        "opportunity_id": "id",
        "account_id": "account_id",
        "opportunity_name": "name",
        "stage_name": "stage_name",
        "amount_usd": "amount",
        "probability_pct": "probability",
        "is_closed": "is_closed",
        "is_won": "is_won",
        "close_date": "close_date",
        "created_at": ("created_date", WALL),
        "owner_id": "owner_id",
        "opportunity_type": "type",
        "lead_source": "lead_source",
        "loaded_at": synced,
    })


def stg_customers(raw: DataFrame, synced: str = "synced_at") -> DataFrame:
    return raw.select(
        F.col("id").alias("customer_id"),
        "email",
        F.col("name").alias("customer_name"),
        json_field(F.col("metadata"), "$.account_id").alias("salesforce_account_id"),
        F.col("created").cast(WALL).alias("created_at"),
        F.col(synced).alias("loaded_at"),
    )


def stg_subscriptions(raw: DataFrame, synced: str = "synced_at") -> DataFrame:
    return raw.select(
        F.col("id").alias("subscription_id"),
        "customer_id",
        F.col("status").alias("subscription_status"),
        cents_to_dollars(F.col("plan_amount")).alias("plan_amount_usd"),
        "plan_interval",
        F.col("current_period_start").cast(WALL).alias("period_start_at"),
        F.col("current_period_end").cast(WALL).alias("period_end_at"),
        F.col("canceled_at").cast(WALL).alias("canceled_at"),
        F.col("created").cast(WALL).alias("created_at"),
        F.col(synced).alias("loaded_at"),
    )


def stg_contacts(raw: DataFrame, synced: str = "synced_at") -> DataFrame:
    return rename_cast(raw, {
        "contact_id": "id",
        "email": "property_email",
        "first_name": "property_firstname",
        "last_name": "property_lastname",
        "lifecycle_stage": "property_lifecyclestage",
        "lead_status": "property_hs_lead_status",
        "created_at": ("property_createdate", WALL),
        "loaded_at": synced,
    })


def stg_workers(raw: DataFrame, synced: str = "synced_at") -> DataFrame:
    return rename_cast(raw, {
        "employee_id": "worker_id",
        "email": "email",
        "first_name": "first_name",
        "last_name": "last_name",
        "department": "department",
        "cost_center": "cost_center",
        "job_title": "job_title",
        "employment_status": "employment_status",
        "hire_date": ("hire_date", "date"),
        "termination_date": ("termination_date", "date"),
        "fte": "fte",
        "manager_id": "manager_id",
        "loaded_at": synced,
    })
