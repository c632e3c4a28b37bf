from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from tidemark.operators import finance, marketing
from tidemark.plans.contracts import CAMPAIGNS, contract_check

SPEND = "campaign_id string, activity_date date, spend_usd decimal(18,2), impressions bigint, clicks bigint"
NAMES = "campaign_id string, campaign_name string, channel string"
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def _report(spark, spend, revenue, pipeline, leads):
    dated = "campaign_id string, activity_date date"
    return marketing.campaign_report(
        spark.createDataFrame(spend, SPEND), spark.createDataFrame([("a", "A", "email"), ("b", "B", "organic")], NAMES),
        spark.createDataFrame(revenue, f"{dated}, attributed_revenue_usd decimal(28,11)"),
        spark.createDataFrame(pipeline, f"{dated}, attributed_pipeline_usd decimal(28,11)"), spark.createDataFrame(leads, dated))


def test_days_that_one_side_knows_stay_and_rows_meet_the_contract(spark):
    report = _report(spark, [("a", D1, D("10.00"), 5, 1), ("a", D1, D("5.50"), None, 1), ("b", D1, D("0.01"), 1, 1), (None, D1, D(1), 1, 1)],
                     [("a", D1, D("31")), ("b", D1, D("500")), ("a", None, D(9))], [("a", D2, D("7.005"))],
                     [("a", D1), ("a", D1), ("unlisted", D2), (None, D2)])
    found = {(r.campaign_id, r.activity_date): tuple(r)[2:] for r in report.collect()}
    assert found == {
        ("a", D1): ("A", "email", D("15.50"), 5, 2, 2, D("0.00"), D("2.0000")),
        ("a", D2): ("A", "email", D("0.00"), 0, 0, 0, D("7.01"), None),
        # 50,000 times its spend: more than decimal(8,4) holds.
        ("b", D1): ("B", "organic", D("0.01"), 1, 1, 0, D("0.00"), None),
        ("unlisted", D2): (None, None, D("0.00"), 0, 0, 1, D("0.00"), None)}
    assert contract_check(report, CAMPAIGNS).filter("status <> 'pass'").count() == 0
    assert contract_check(report.drop("channel"), CAMPAIGNS).filter("status <> 'pass'").select("test_name").collect()[0][0] == "schema_channel"


def test_empty_report(spark):
    assert _report(spark, [], [], [], []).count() == 0


def test_leads_take_the_campaign_of_their_first_touch(spark, rows):
    at = lambda d: datetime(2024, 1, d)
    contacts = spark.createDataFrame([("1", marketing.MQL, at(5)), ("2", "lead", at(5)), ("3", marketing.MQL, at(6)), ("4", marketing.MQL, at(7))],
                                     "contact_id string, lifecycle_stage string, created_at timestamp_ntz")
    touches = spark.createDataFrame([("t2", "1", "b", at(2)), ("t1", "1", "a", at(2)), ("t3", "1", "c", at(3)), ("t4", "2", "a", at(1)),
                                     ("t5", "4", None, at(1))],
                                    "touch_id string, opportunity_id string, campaign_id string, touched_at timestamp_ntz")
    assert rows(marketing.lead_campaigns(contacts, touches)) == [("a", date(2024, 1, 5)), (None, date(2024, 1, 7))]


def test_margin_by_segment_equals_the_sum_of_its_accounts(spark, rows):
    money = spark.createDataFrame(
        [("1", D1, "Income", D(10)), ("1", D2, "Income", D(20)), ("2", D1, "COGS", D(4)), ("3", D1, "COGS", D(9)), ("x", D1, "Income", D(5)),
         (None, D1, "Income", D(1)), ("1", D1, "Other", D(99)), ("2", date(2024, 2, 1), "COGS", D(4))],
        "account_id string, transaction_date date, account_type string, amount decimal(18,2)")
    accounts = spark.createDataFrame([("1", "tech"), ("2", "tech"), ("3", "retail")], "account_id string, industry string")
    found = finance.segment_margin(money, accounts).select("revenue_month", "customer_segment", *[
        F.col(c).cast("int") for c in ("revenue_usd", "cogs_usd", "gross_profit_usd")])
    assert rows(found) == [(D1, "tech", 30, 4, 26), (D1, None, 6, 0, 6)]
    assert finance.segment_margin(money.limit(0), accounts).count() == 0


def test_customers_keep_a_null_name_without_an_account(spark, rows):
    customers = spark.createDataFrame([("c1", "1"), ("c2", "9"), ("c3", None)], "customer_id string, salesforce_account_id string")
    spine = spark.createDataFrame([("1", "One")], "account_id string, account_name string")
    assert rows(finance.customers_spine(customers, spine)) == [("c1", "1", "One"), ("c2", "9", None), ("c3", None, None)]
