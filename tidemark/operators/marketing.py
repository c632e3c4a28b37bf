"""Funnel, campaigns and attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import period_start
from tidemark.functions.values import MONEY, ratio, url_parameter
from tidemark.operators.skew import hot_keys, spread_join

# Lifecycle stages and the W-shaped weights.
MQL, SQL = "marketingqualifiedlead", "salesqualifiedlead"
LATER = ("opportunity", "customer", "evangelist")
MILESTONE_WEIGHT, REST_WEIGHT = 0.3, 0.1


def funnel_metrics(contacts: DataFrame, spend: DataFrame) -> DataFrame:
    """Contacts, qualified contacts and spend per month of contact creation.

    ``mql_count`` counts every contact, as the mart defines it; ``qualified_count`` counts
    those in the qualified stage.
    """
    people = (contacts.groupBy(period_start(F.col("created_at"), "month").alias("activity_month"))
              .agg(F.count("*").alias("mql_count"),
                   F.count(F.when(F.col("lifecycle_stage") == MQL, 1)).alias("qualified_count")))
    money = (spend.groupBy(period_start(F.col("activity_date"), "month").alias("activity_month"))
             .agg(F.sum("spend_usd").alias("spend_usd")))
    cost = F.coalesce("spend_usd", F.lit(0))
    return people.join(money, "activity_month", "left").select(
        "activity_month", "mql_count", "qualified_count", cost.cast(MONEY).alias("marketing_spend_usd"),
        F.when(F.col("mql_count") > 0, ratio(cost, F.col("mql_count"))).alias("cost_per_mql_usd"))


def funnel_conversion(contacts: DataFrame) -> DataFrame:
    """MQL to SQL rate per month of contact creation."""
    stage = F.col("lifecycle_stage")
    counted = (contacts.groupBy(period_start(F.col("created_at"), "month").alias("activity_month"))
               .agg(F.count(F.when(stage == MQL, 1)).alias("mqls"), F.count(F.when(stage == SQL, 1)).alias("sqls")))
    return counted.withColumn("mql_to_sql_rate", ratio(F.col("sqls"), F.col("mqls")))


def funnel_reached(contacts: DataFrame) -> DataFrame:
    """MQL to SQL rate per month of contact creation, counting who ever got that far.

    A contact's stage is its present one; who stands at a later stage has passed the earlier ones,
    so the rate cannot exceed 1.
    """
    stage = F.col("lifecycle_stage")
    counted = (contacts.groupBy(period_start(F.col("created_at"), "month").alias("activity_month"))
               .agg(F.count(F.when(stage.isin(MQL, SQL, *LATER), 1)).alias("reached_mql"),
                    F.count(F.when(stage.isin(SQL, *LATER), 1)).alias("reached_sql")))
    return counted.withColumn("mql_to_sql_rate", ratio(F.col("reached_sql"), F.col("reached_mql")))


def daily_mqls(contacts: DataFrame) -> DataFrame:
    """Qualified contacts per day of creation."""
    return (contacts.filter(F.col("lifecycle_stage") == MQL).groupBy(F.col("created_at").cast("date").alias("activity_date"))
            .agg(F.count("*").alias("mqls")))


def campaign_returns(days: DataFrame) -> DataFrame:
    """Campaign x month from ``campaign_performance`` rows: sums, and the return on the summed spend."""
    sums = [F.sum(c).alias(c) for c in ("spend_usd", "impressions", "clicks", "attributed_revenue_usd")]
    months = days.groupBy("campaign_id", period_start(F.col("activity_date"), "month").alias("activity_month")).agg(*sums)
    return months.withColumn("roas", ratio(F.col("attributed_revenue_usd"), F.col("spend_usd")))


def cost_per_mql(leads: DataFrame, spend: DataFrame) -> DataFrame:
    """Spend per qualified lead by channel and month.  ``leads`` carries a ``channel``."""
    qualified = (leads.filter(F.col("lifecycle_stage") == MQL)
                 .groupBy("channel", period_start(F.col("created_at"), "month").alias("activity_month"))
                 .agg(F.count("*").alias("mqls")))
    money = (spend.groupBy("channel", period_start(F.col("activity_date"), "month").alias("activity_month"))
             .agg(F.sum("spend_usd").alias("spend_usd")))
    return money.join(qualified, ["channel", "activity_month"], "left").select(
        "channel", "activity_month", "spend_usd", F.coalesce("mqls", F.lit(0)).alias("mqls"),
        ratio(F.col("spend_usd"), F.col("mqls")).alias("cost_per_mql_usd"))


def campaign_performance(spend: DataFrame, attributed: DataFrame) -> DataFrame:
    """Campaign x day: spend, reach, attributed revenue and its return.

    ``attributed`` has ``campaign_id, activity_date, attributed_revenue_usd``.  A day with
    revenue and no spend stays, with a null return.
    """
    keys = ["campaign_id", "activity_date"]
    cost = spend.groupBy(*keys).agg(F.sum("spend_usd").alias("spend_usd"), F.sum("impressions").alias("impressions"),
                                    F.sum("clicks").alias("clicks"))
    earned = attributed.groupBy(*keys).agg(F.sum("attributed_revenue_usd").alias("attributed_revenue_usd"))
    zero = F.lit(0)
    return cost.join(earned, keys, "full").select(
        *keys, F.coalesce("spend_usd", zero).alias("spend_usd"), F.coalesce("impressions", zero).alias("impressions"),
        F.coalesce("clicks", zero).alias("clicks"),
        F.coalesce("attributed_revenue_usd", zero).alias("attributed_revenue_usd"),
        ratio(F.coalesce("attributed_revenue_usd", zero), F.col("spend_usd")).alias("roas"))


def lead_campaigns(contacts: DataFrame, touches: DataFrame, key: str = "opportunity_id") -> DataFrame:
    """``campaign_id, activity_date``, a row per qualified contact: the campaign of its first touch, on the day it was created.

    ``touches`` name the contact by ``key``.  Contacts that nothing touched have no campaign and are left out.
    """
    first = touches.groupBy(F.col(key).alias("contact_id")).agg(
        F.min(F.struct("touched_at", "touch_id", "campaign_id")).alias("first")).select("contact_id", "first.campaign_id")
    qualified = contacts.filter(F.col("lifecycle_stage") == MQL).select(
        "contact_id", F.col("created_at").cast("date").alias("activity_date"))
    return qualified.join(first, "contact_id").select("campaign_id", "activity_date")


def campaign_report(spend: DataFrame, campaigns: DataFrame, revenue: DataFrame, pipeline: DataFrame,
                    leads: DataFrame) -> DataFrame:
    """The published campaign mart: one row per campaign and day, in the types of its contract.

    ``campaigns`` has ``campaign_id, campaign_name, channel``, ids at most once; ``revenue`` and ``pipeline`` have ``campaign_id,
    activity_date`` and ``attributed_revenue_usd`` or ``attributed_pipeline_usd``; ``leads`` a row per qualified lead.  All four
    are stacked and added up in one aggregate, so a day that only one of them knows stays.  A campaign that is not
    listed has no name; rows without a campaign or a day are left out; ``roas`` is null without spend, and where
    the contract's decimal cannot hold it.
    """
    measures = {"spend_usd": MONEY, "impressions": "bigint", "clicks": "bigint", "attributed_revenue_usd": "decimal(28,11)",
                "attributed_pipeline_usd": "decimal(28,11)", "mql_count": "bigint"}

    def of(df, **own):
        return df.select("campaign_id", "activity_date", *[
            own.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in measures.items()])

    stacked = (of(spend, **{c: F.col(c) for c in ("spend_usd", "impressions", "clicks")})
               .unionByName(of(revenue, attributed_revenue_usd=F.col("attributed_revenue_usd")))
               .unionByName(of(pipeline, attributed_pipeline_usd=F.col("attributed_pipeline_usd")))
               .unionByName(of(leads, mql_count=F.lit(1))))
    days = stacked.filter("campaign_id is not null and activity_date is not null").groupBy("campaign_id", "activity_date").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures])
    named = days.join(campaigns.select("campaign_id", "campaign_name", "channel"), "campaign_id", "left")
    return named.select(
        "campaign_id", "activity_date", "campaign_name", "channel", F.col("spend_usd").cast(MONEY).alias("spend_usd"),
        *[F.col(c).cast("int").alias(c) for c in ("impressions", "clicks", "mql_count")],
        F.col("attributed_pipeline_usd").cast(MONEY).alias("attributed_pipeline_usd"),
        ratio(F.col("attributed_revenue_usd"), F.col("spend_usd")).try_cast("decimal(8,4)").alias("roas"))


def attribution_w(touches: DataFrame, opportunities: DataFrame) -> DataFrame:
    """W-shaped weights: 0.3 each for the first touch, the last touch up to lead creation and
    the last touch up to opportunity creation; the other touches share 0.1.

    ``touches``: touch_id, opportunity_id, touched_at; id and time name a touch.  ``opportunities``: opportunity_id,
    lead_created_at, created_at.  Coinciding milestones add up; missing parts are scaled
    away, so weights sum to 1 per opportunity.  Milestones are aggregates with map-side
    combine, and both joins spread the touches of a heavy opportunity: they are never sorted
    or gathered in one task.
    """
    at = F.struct("touched_at", "touch_id")
    hot = hot_keys(touches, "opportunity_id")
    dates = opportunities.select("opportunity_id", "lead_created_at", F.col("created_at").alias("opp_created_at"))
    dated = spread_join(touches, dates, "opportunity_id", spread_by=["touch_id"], hot=hot)
    marks = dated.groupBy("opportunity_id").agg(
        F.min(at).alias("first_touch"),
        F.max(F.when(F.col("touched_at") <= F.col("lead_created_at"), at)).alias("lead_touch"),
        F.max(F.when(F.col("touched_at") <= F.col("opp_created_at"), at)).alias("opp_touch"),
        F.count("*").alias("touches"))
    milestones = F.array_distinct(F.array_compact(F.array("first_touch", "lead_touch", "opp_touch")))
    marks = (marks.withColumn("others", F.col("touches") - F.size(milestones))
             .withColumn("total", F.lit(MILESTONE_WEIGHT)
                         * (1 + F.col("lead_touch").isNotNull().cast("int") + F.col("opp_touch").isNotNull().cast("int"))
                         + F.when(F.col("others") > 0, REST_WEIGHT).otherwise(0.0)))
    hits = sum((F.coalesce(at == F.col(c), F.lit(False)).cast("int")
                for c in ("first_touch", "lead_touch", "opp_touch")), F.lit(0))
    joined = spread_join(touches, marks, "opportunity_id", spread_by=["touch_id"], hot=hot).withColumn("hits", hits)
    raw = F.when(F.col("hits") > 0, F.col("hits") * MILESTONE_WEIGHT).otherwise(F.lit(REST_WEIGHT) / F.col("others"))
    return joined.select(*touches.columns, (raw / F.col("total")).alias("weight"))


def pipeline_influenced(opportunities: DataFrame, touches: DataFrame) -> DataFrame:
    """Share of open pipeline with at least one touch, per close month."""
    touched = touches.select("opportunity_id").distinct().withColumn("touched", F.lit(True))
    rows = opportunities.filter(~F.col("is_closed")).join(touched, "opportunity_id", "left")
    totals = rows.groupBy(period_start(F.col("close_date"), "month").alias("close_month")).agg(
        F.sum("amount_usd").alias("pipeline_usd"),
        F.coalesce(F.sum(F.when(F.col("touched"), F.col("amount_usd"))), F.lit(0)).alias("influenced_usd"))
    return totals.withColumn("influenced_share", ratio(F.col("influenced_usd"), F.col("pipeline_usd")))


def utm_params(df: DataFrame, url: str, names: Sequence[str]) -> DataFrame:
    """Add one column per URL parameter in ``names``."""
    return df.withColumns({n: url_parameter(F.col(url), n) for n in names})
