"""Feature, segment and churn queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import finance, product, scoring
from tidemark.session import checkpointed, work_dir
from tidemark.sources import landing
from workload.bindings import AS_OF_EVENTS
from workload.context import EVENTS_FROM, Registry

R = Registry()


def _engagement(c):
    return product.account_daily_engagement(
        product.account_engagement(c.raw["raw_event"], EVENTS_FROM, AS_OF_EVENTS))


def _revenue(c):
    return c.marts.monthly_revenue


_FEATURES = """
    d as (select *, sum(dau) over (partition by account_id order by activity_date rows 29 preceding) as mau
          from m_engagement),
    e as (select account_id, cast(sum(dau) as double) / count(*) as avg_dau, cast(sum(mau) as double) / count(*) as avg_mau,
                 max(activity_date) as last_active from d group by 1),
    r as (select account_id, max(cents) / 100.0 as arr_usd from m_revenue group by 1),
    f as (select e.*, coalesce(r.arr_usd, 0) as arr_usd from e left join r on r.account_id = e.account_id)"""
R.add("account_features", lambda c: scoring.account_features(_engagement(c), _revenue(c)),
      f"with {_FEATURES} select *, avg_dau / greatest(avg_mau, 1) as dau_mau_ratio from f")
R.add("dau_mau_ratio", lambda c: scoring.account_features(_engagement(c), _revenue(c)).select(
    "account_id", "dau_mau_ratio"), f"with {_FEATURES} select account_id, avg_dau / greatest(avg_mau, 1) as dau_mau_ratio from f")


def _churn_features(c):
    return scoring.churn_features(_engagement(c), _revenue(c), AS_OF_EVENTS)


def _labels(c):
    unfiltered = finance.subscription_mrr(c.marts.subscriptions, c.marts.customers, c.marts.accounts, statuses=None)
    return scoring.churn_labels(unfiltered)


_CHURN = f"""{_FEATURES},
    cf as (select account_id, avg_dau, avg_mau, arr_usd,
                  cast(date '{AS_OF_EVENTS}' - last_active as double) as days_since_active from f),
    cl as (select a.account_id, cast(max(case when s.canceled_at is not null then 1 else 0 end) as double) as churned
           from s_subscription s join s_customer k on k.customer_id = s.customer_id
           join s_account a on a.account_id = k.salesforce_account_id group by 1)"""
R.add("churn_features", _churn_features, f"with {_CHURN} select * from cf")
R.add("churn_labels", _labels, f"with {_CHURN} select * from cl")
R.add("features_labels", lambda c: scoring.training_rows(_churn_features(c), _labels(c)),
      f"with {_CHURN} select cf.*, cl.churned from cf join cl on cl.account_id = cf.account_id")
R.add("segment_accounts", lambda c: scoring.segment_accounts(
    scoring.account_features(_engagement(c), _revenue(c)), AS_OF_EVENTS))
R.add("churn_scores", lambda c: scoring.churn_scores(_churn_features(c), _labels(c), AS_OF_EVENTS))


def _written(c, scores, schema: str):
    """Scores as their table holds them after a second run has replaced the first."""
    path = work_dir(c.spark, "scores")
    for _ in range(2):
        landing.overwrite_table(scores, path)
    return c.spark.read.schema(schema).parquet(path)


def _segment_summary(c):
    features = checkpointed(scoring.account_features(_engagement(c), _revenue(c)), "features")
    scores = _written(c, scoring.segment_accounts(features, AS_OF_EVENTS), "account_id string, scored_at date, segment_name string")
    arr = scores.join(features, "account_id").groupBy("segment_name").agg(F.avg("arr_usd").alias("mean_arr"))
    place = F.array_position(F.array(*[F.lit(n) for n in scoring.SEGMENTS]), F.col("segment_name"))
    # Five segments at most.
    means = arr.agg(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), "mean_arr"))),
                                lambda x: x["mean_arr"]).alias("m")).select((F.array_sort("m") == F.col("m")).alias("ordered"))
    return scores.agg(F.count("*").alias("accounts"), F.count_distinct("account_id").alias("scored")).withColumn(
        "ordered_by_arr", means.scalar())


def _churn_summary(c):
    scores = _written(c, scoring.churn_scores(_churn_features(c), _labels(c), AS_OF_EVENTS),
                      "account_id string, churn_predicted double, churn_probability double, scored_at date")
    likely = F.col("churn_probability")
    return scores.agg(
        F.count("*").alias("accounts"), F.count_distinct("account_id").alias("scored"),
        F.bool_and(likely.between(0, 1)).alias("all_probabilities"),
        F.bool_and((likely > 0.5) == (F.col("churn_predicted") == 1)).alias("predictions_agree"))


R.add("segment_summary", _segment_summary, f"""
    with {_FEATURES} select count(*) as accounts, count(distinct account_id) as scored, true as ordered_by_arr from f""")
R.add("churn_summary", _churn_summary, f"""
    with {_CHURN} select count(*) as accounts, count(distinct account_id) as scored, true as all_probabilities,
           true as predictions_agree from cf""")
