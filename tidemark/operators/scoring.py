"""Account features, segments and churn scores with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import day, days_between
from tidemark.functions.values import ratio
from tidemark.session import checkpointed

# Segment names from the lowest to the highest mean ARR.
SEGMENTS = ("dormant", "low_touch", "growth", "power_user", "enterprise")
SEGMENT_INPUTS = ("avg_dau", "avg_mau", "arr_usd", "dau_mau_ratio")
CHURN_INPUTS = ("avg_dau", "avg_mau", "arr_usd", "days_since_active")


def dau_mau_ratio(avg_dau: Column, avg_mau: Column) -> Column:
    return avg_dau / F.greatest(avg_mau, F.lit(1.0))


def _per_account(engagement: DataFrame, revenue: DataFrame) -> DataFrame:
    """Both sides are aggregated per account before they meet: the join is one to one."""
    used = engagement.groupBy("account_id").agg(
        ratio(F.sum("dau"), F.count("dau")).alias("avg_dau"), ratio(F.sum("mau"), F.count("mau")).alias("avg_mau"),
        F.max("activity_date").alias("last_active"))
    paid = revenue.groupBy("account_id").agg(F.max("arr_usd").cast("double").alias("arr_usd"))
    return used.join(paid, "account_id", "left")


def account_features(engagement: DataFrame, revenue: DataFrame) -> DataFrame:
    joined = _per_account(engagement, revenue).fillna(0, ["avg_dau", "avg_mau", "arr_usd"])
    return joined.select("account_id", "avg_dau", "avg_mau", "last_active", "arr_usd",
                         dau_mau_ratio(F.col("avg_dau"), F.col("avg_mau")).alias("dau_mau_ratio"))


def churn_features(engagement: DataFrame, revenue: DataFrame, as_of: date | str) -> DataFrame:
    """Features per account; nulls become 0 for training and scoring alike."""
    seen = engagement.filter(F.col("activity_date") <= day(as_of))
    return _per_account(seen, revenue).select(
        "account_id", "avg_dau", "avg_mau", "arr_usd",
        days_between(F.col("last_active"), day(as_of)).cast("double").alias("days_since_active")
    ).fillna(0, list(CHURN_INPUTS))


def churn_labels(subscriptions: DataFrame, canceled_from: date | str | None = None,
                 canceled_to: date | str | None = None) -> DataFrame:
    """One label per account: 1 if any of its subscriptions was canceled (in the window).

    ``subscriptions`` must not be cut to billable states, which would hide cancellations.
    """
    hit = F.col("canceled_at").isNotNull()
    if canceled_from is not None:
        hit = hit & (F.col("canceled_at").cast("date") >= day(canceled_from))
    if canceled_to is not None:
        hit = hit & (F.col("canceled_at").cast("date") < day(canceled_to))
    return (subscriptions.filter(F.col("account_id").isNotNull()).groupBy("account_id")
            .agg(F.max(F.when(hit, 1.0).otherwise(0.0)).alias("churned")))


def training_rows(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, "account_id", "inner")


def segment_accounts(features: DataFrame, scored_at: date | str, k: int = 5, seed: int = 42,
                     names: Sequence[str] = SEGMENTS) -> DataFrame:
    """K-means on scaled features; clusters are named by their rank in mean ARR, then DAU.

    Scaling divides by the standard deviation without centring.  The features are written
    once, because fit and transform read them many times.
    """
    if len(names) != k:
        raise ValueError("one name per cluster")
    table = checkpointed(features.select("account_id", *SEGMENT_INPUTS), "segment-features")
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=list(SEGMENT_INPUTS), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")])
    scored = pipeline.fit(table).transform(table)
    # One row per cluster, k at most: ranking and looking up names is tiny by construction.
    rank = F.row_number().over(Window.orderBy("mean_arr", "mean_dau", "cluster"))
    clusters = (scored.groupBy("cluster").agg(F.avg("arr_usd").alias("mean_arr"), F.avg("avg_dau").alias("mean_dau"))
                .withColumn("segment_name", F.element_at(F.array(*[F.lit(n) for n in names]), rank))
                .select("cluster", "segment_name"))
    return scored.join(F.broadcast(clusters), "cluster").select(
        "account_id", day(scored_at).alias("scored_at"), "segment_name")


def churn_scores(features: DataFrame, labels: DataFrame, scored_at: date | str, max_iter: int = 50,
                 seed: int = 42) -> DataFrame:
    """Gradient-boosted trees on the labelled accounts, applied to all of them."""
    table = checkpointed(features.select("account_id", *CHURN_INPUTS), "churn-features")
    train = checkpointed(training_rows(table, labels), "churn-training")
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=list(CHURN_INPUTS), outputCol="features"),
        GBTClassifier(labelCol="churned", featuresCol="features", maxIter=max_iter, seed=seed)])
    scored = pipeline.fit(train).transform(table)
    return scored.select("account_id", F.col("prediction").alias("churn_predicted"),
                         vector_to_array("probability")[1].alias("churn_probability"),
                         day(scored_at).alias("scored_at"))
