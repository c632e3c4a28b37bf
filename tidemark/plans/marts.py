"""The layers wired together: raw tables in, marts and semantic views out.

Every property is a lazy DataFrame.  ``materialize`` turns a node that several
others read into a written table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.values import attributed_revenue_proxy
from tidemark.operators import finance, marketing, people, product, sales, staging
from tidemark.operators.relational import exclude_ids
from tidemark.session import checkpointed


@dataclass(frozen=True)
class Settings:
    """Dates and switches of one run.  ``test_ids`` are excluded wherever an account id exists."""

    as_of: str
    start: str
    events_from: str
    events_to: str
    test_ids: tuple[str, ...] = ()


class Marts:
    """Marts over ``raw``, a mapping from raw table name to DataFrame."""

    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings):
        self.raw, self.settings = raw, settings

    def materialize(self, name: str) -> DataFrame:
        """Compute the node ``name`` once, as a table in the shared folder."""
        table = checkpointed(getattr(self, name), f"mart-{name}")
        self.__dict__[name] = table
        return table

    def _real(self, df: DataFrame) -> DataFrame:
        """Drop test accounts; rows without any account stay."""
        return exclude_ids(df, "account_id", self.settings.test_ids, keep_null=True)

    # staging
    @cached_property
    def accounts(self) -> DataFrame:
        return staging.stg_accounts(self.raw["raw_account"], self.settings.test_ids)

    @cached_property
    def opportunities(self) -> DataFrame:
        return self._real(staging.stg_opportunities(self.raw["raw_opportunity"]))

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["raw_billing_customer"])

    @cached_property
    def subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw["raw_subscription"])

    @cached_property
    def contacts(self) -> DataFrame:
        return staging.stg_contacts(self.raw["raw_contact"])

    @cached_property
    def workers(self) -> DataFrame:
        return staging.stg_workers(self.raw["raw_worker"])

    # marts
    @cached_property
    def account_spine(self) -> DataFrame:
        return finance.account_spine(self.accounts, self.customers)

    @cached_property
    def subscription_mrr(self) -> DataFrame:
        return finance.subscription_mrr(self.subscriptions, self.customers, self.accounts)

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return finance.monthly_revenue(self.subscription_mrr, self.accounts, self.settings.start,
                                       self.settings.as_of)

    @cached_property
    def arr_totals(self) -> DataFrame:
        totals = finance.arr_by_month(self.subscription_mrr, self.accounts, self.settings.start, self.settings.as_of)
        return totals.withColumnRenamed("total_arr", "arr_usd")

    @cached_property
    def gross_margin(self) -> DataFrame:
        return finance.gross_margin(self.raw["raw_transaction"])

    @cached_property
    def pipeline_snapshot(self) -> DataFrame:
        return sales.pipeline_snapshot(self.opportunities, self.settings.as_of)

    @cached_property
    def win_rate(self) -> DataFrame:
        return sales.win_rate(self.opportunities)

    @cached_property
    def funnel_metrics(self) -> DataFrame:
        return marketing.funnel_metrics(self.contacts, self.raw["raw_ad_spend"])

    @cached_property
    def account_engagement(self) -> DataFrame:
        events = self._real(self.raw["raw_event"])
        return product.account_engagement(events, self.settings.events_from, self.settings.events_to)

    @cached_property
    def daily_engagement(self) -> DataFrame:
        return product.daily_engagement(self.account_engagement)

    @cached_property
    def monthly_headcount(self) -> DataFrame:
        return people.headcount(self.workers, self.settings.as_of)

    # semantic views
    @cached_property
    def revenue_kpis(self) -> DataFrame:
        return self.monthly_revenue.select("account_id", "revenue_month", "mrr_usd", "arr_usd")

    @cached_property
    def sales_kpis(self) -> DataFrame:
        return self.pipeline_snapshot.select("opportunity_id", "account_id", "snapshot_date", "amount_usd",
                                             "weighted_amount_usd", "stage_name")

    @cached_property
    def sales_win_rate(self) -> DataFrame:
        return self.win_rate.select("fiscal_quarter", "win_rate")

    @cached_property
    def sales_win_counts(self) -> DataFrame:
        return self.win_rate.select("fiscal_quarter", "won_count", "closed_count")

    @cached_property
    def marketing_kpis(self) -> DataFrame:
        spend = F.col("marketing_spend_usd")
        return self.funnel_metrics.select(
            "activity_month", spend.alias("marketing_spend"), F.col("mql_count").alias("new_customers"),
            spend.alias("ad_spend"), attributed_revenue_proxy(spend).alias("attributed_revenue"))

    @cached_property
    def finance_kpis(self) -> DataFrame:
        return self.gross_margin.select(F.col("revenue_month").alias("activity_month"),
                                        F.col("revenue_usd").alias("revenue"), F.col("cogs_usd").alias("cogs"),
                                        "gross_margin_pct")

    @cached_property
    def product_kpis(self) -> DataFrame:
        return self.daily_engagement.select("activity_date", "dau", "mau", "dau_mau_ratio")

    @cached_property
    def product_users(self) -> DataFrame:
        """Day: distinct users, and distinct users of the last 30 days, over all accounts."""
        return product.active_users(self._real(self.raw["raw_event"]), self.settings.events_from, self.settings.events_to)

    @cached_property
    def hr_kpis(self) -> DataFrame:
        return people.hr_rollup(self.monthly_headcount)
