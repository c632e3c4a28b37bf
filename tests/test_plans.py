from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.relational import exclude_ids
from tidemark.plans import contracts, metrics
from tidemark.session import work_dir
from workload.context import Context

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ctx(spark):
    return Context(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unknown_names_and_finer_grains_are_rejected(ctx):
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.metric(ctx.marts, "profit")
    with pytest.raises(ValueError, match="month rows"):
        metrics.metric(ctx.marts, "arr", "week")
    with pytest.raises(ValueError, match="quarter rows"):
        metrics.metric(ctx.marts, "win_rate", "month")
    with pytest.raises(ValueError, match="unknown grain"):
        metrics.metric(ctx.marts, "dau", "hour")
    with pytest.raises(ValueError, match="no dimensions"):
        metrics.metric(ctx.marts, "revenue", dims=["account_id"])


def test_catalogue_is_complete(ctx):
    assert len(metrics.METRICS) == 18
    assert sum(len(m.measures) for m in metrics.MODELS) == 16
    for metric in metrics.METRICS.values():
        assert all(metrics.model_of(i) for i in metric.inputs)


def test_scopes(spark, ctx):
    assert set(metrics.allowed_metrics(["hr"])) == {"headcount"}
    assert set(metrics.allowed_metrics(["hr"], beyond_served=True)) == {"headcount", "terminations", "attrition_rate"}
    assert set(metrics.allowed_metrics(["admin"])) == set(metrics.SERVED)
    assert len(metrics.allowed_metrics(["admin"], beyond_served=True)) == 18
    assert metrics.allowed_metrics([]) == []
    assert metrics.visible_metrics(spark, ["sales"]).count() == 2
    rows = spark.sql("select * from values ('arr', 1), ('dau', 2) t(metric, value)")
    assert [r.metric for r in metrics.scope_filter(rows, ["product"]).collect()] == ["dau"]
    assert metrics.scope_filter(rows, ["nobody"]).count() == 0


def test_derived_metrics_divide_totals_and_keep_nulls(spark):
    class Fake:
        marketing_kpis = spark.sql("""
            select * from values (date'2024-01-01', 10.0, 0, 0.0, 5.0), (date'2024-02-01', 20.0, 4, 10.0, 30.0),
                                 (date'2024-03-01', 10.0, 1, 0.0, 5.0)
            t(activity_month, marketing_spend, new_customers, ad_spend, attributed_revenue)""")

    by_month = {r.period.month: r.value for r in metrics.metric(Fake, "cac").collect()}
    assert by_month == {1: None, 2: 5.0, 3: 10.0}
    assert metrics.metric(Fake, "cac", "quarter").first().value == 8.0
    assert metrics.metric(Fake, "roas", "quarter").first().value == 4.0


def test_recurring_revenue_is_preserved(ctx):
    """No fan-out: a month's MRR is the sum over the subscriptions that cover it."""
    mrr = ctx.marts.subscription_mrr.filter(F.col("account_id").isNotNull())
    month = F.lit("1998-06-01").cast("date")
    direct = mrr.filter(
        (F.trunc("period_start_at", "month") <= month)
        & (F.coalesce("canceled_at", "period_end_at") >= month.cast("timestamp_ntz"))).agg(F.sum("annual_cents")).first()[0]
    mart = ctx.marts.monthly_revenue.filter(F.col("revenue_month") == month).agg(F.sum("arr_usd")).first()[0]
    assert int(mart * 100) == direct


def test_test_accounts_are_out_of_every_mart(ctx):
    ids = list(ctx.marts.settings.test_ids)
    for df in (ctx.marts.accounts, ctx.marts.opportunities, ctx.marts.monthly_revenue, ctx.marts.account_engagement,
               ctx.marts.sales_kpis):
        assert df.filter(F.col("account_id").isin(ids)).count() == 0


def test_exclusion_keeps_null_only_on_request(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    many = [f"x{i}" for i in range(300)] + ["a"]
    assert exclude_ids(df, "id", ["a"], keep_null=True).count() == 2
    assert exclude_ids(df, "id", many, keep_null=True).count() == 2
    assert exclude_ids(df, "id", many).count() == 1


def test_contract_sees_schema_and_key_breaks(spark):
    df = spark.sql("""select * from values ('a', date'2024-01-01', cast(1 as decimal(18,2))), ('a', date'2024-01-01', -1)
                      t(account_id, revenue_month, mrr_usd)""")
    got = {r.test_name: r.status for r in contracts.contract_check(df, contracts.REVENUE).collect()}
    assert got["unique_account_id_revenue_month"] == "fail" and got["between_mrr_usd"] == "fail"
    assert got["schema_arr_usd"] == "fail" and got["schema_account_id"] == "pass"


def test_filters_and_columns_reach_the_scan(ctx):
    text = plan(ctx.marts.account_engagement)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    text = plan(ctx.marts.gross_margin)
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_windows_on_raw_rows_are_partitioned(ctx):
    text = plan(ctx.marts.monthly_revenue)
    assert "Exchange SinglePartition" not in text


def test_materialized_marts_are_read_back(spark):
    marts = Context(spark, SF).marts
    before = marts.gross_margin.count()
    table = marts.materialize("gross_margin")
    assert marts.gross_margin is table and table.count() == before
    assert "mart-gross_margin" in table.inputFiles()[0]


class _Session:
    """Just enough of a session to name its folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.master, self.conf, self.folder = master, self, folder

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_work_dir_uses_the_shared_folder_and_refuses_without_one_on_a_cluster():
    assert work_dir(_Session("spark://host:7077", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_dir(_Session("local[2]", "/shared"), "x").startswith("/shared/x-")
    with pytest.raises(ValueError):
        work_dir(_Session("spark://host:7077"), "x")
