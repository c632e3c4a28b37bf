"""Data contracts of published marts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.quality import Between, NotNull, Test, Unique, run_suite


@dataclass(frozen=True)
class Contract:
    dataset: str
    primary_key: tuple[str, ...]
    columns: Mapping[str, str]
    not_null: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    tier: int = 1
    version: str = "1.0.0"

    def tests(self) -> list[Test]:
        checks: list[Test] = [NotNull(c) for c in self.not_null]
        checks += [Between(c, low, high) for c, (low, high) in self.ranges.items()]
        return checks + [Unique(self.primary_key)]


REVENUE = Contract(
    dataset="monthly_revenue",
    primary_key=("account_id", "revenue_month"),
    columns={"account_id": "string", "revenue_month": "date", "mrr_usd": "decimal(18,2)", "arr_usd": "decimal(18,2)"},
    not_null=("account_id", "revenue_month", "mrr_usd", "arr_usd"),
    ranges={"mrr_usd": (0, None), "arr_usd": (0, None)},
)
PIPELINE = Contract(
    dataset="pipeline_snapshot",
    primary_key=("opportunity_id",),
    columns={"opportunity_id": "string", "snapshot_date": "date", "stage_name": "string",
             "amount_usd": "decimal(18,2)", "probability_pct": "decimal(5,2)", "is_closed": "boolean",
             "is_won": "boolean"},
    not_null=("opportunity_id",),
    ranges={"amount_usd": (0, None)},
)
ENGAGEMENT = Contract(
    dataset="daily_engagement",
    primary_key=("activity_date",),
    columns={"activity_date": "date", "dau": "bigint", "active_accounts": "bigint", "mau": "bigint"},
    not_null=("activity_date",),
    tier=2,
)
CAMPAIGNS = Contract(
    dataset="campaign_performance",
    primary_key=("campaign_id", "activity_date"),
    columns={"campaign_id": "string", "activity_date": "date", "campaign_name": "string", "channel": "string",
             "spend_usd": "decimal(18,2)", "impressions": "int", "clicks": "int", "mql_count": "int",
             "attributed_pipeline_usd": "decimal(18,2)", "roas": "decimal(8,4)"},
    not_null=("campaign_id", "activity_date"),
    ranges={"spend_usd": (0, None), "mql_count": (0, None)},
    tier=2,
)


def contract_check(df: DataFrame, contract: Contract) -> DataFrame:
    """Schema, key and value gates of one contract, one row per gate."""
    actual = dict(df.dtypes)
    checks = [t for t in contract.tests()
              if all(c in actual for c in (t.columns if isinstance(t, Unique) else (t.column,)))]
    gates = run_suite({contract.dataset: df}, {contract.dataset: checks}, {contract.dataset: contract.tier})
    # Schema gates are known while the plan is built.
    schema = [F.struct(F.lit(f"schema_{c}").alias("test_name"),
                       F.lit(0 if actual.get(c) == t else 1).cast("bigint").alias("failures"))
              for c, t in contract.columns.items()]
    listed = df.sparkSession.range(1).select(F.explode(F.array(*schema)).alias("r")).select("r.*")
    rows = listed.select(F.lit(contract.dataset).alias("table_name"), "test_name", F.lit(contract.tier).alias("tier"),
                         "failures", F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"))
    return gates.unionByName(rows)
