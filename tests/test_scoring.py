from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import scoring


def features(spark):
    rows = []
    for g, (dau, mau, arr) in enumerate([(0.1, 1.0, 0.0), (1.0, 10.0, 100.0), (5.0, 40.0, 1000.0), (9.0, 90.0, 10000.0),
                                         (20.0, 200.0, 100000.0)]):
        rows += [(f"{g}-{i}", dau + i * 0.001, mau + i * 0.001, arr + i, dau / mau) for i in range(20)]
    return spark.createDataFrame(rows, "account_id string, avg_dau double, avg_mau double, arr_usd double, dau_mau_ratio double")


def test_segments_are_named_by_rank(spark):
    df = features(spark)
    scored = scoring.segment_accounts(df, "2024-01-31")
    assert scored.count() == 100
    means = scored.join(df, "account_id").groupBy("segment_name").agg(F.avg("arr_usd").alias("m")).collect()
    order = [r.segment_name for r in sorted(means, key=lambda r: r.m)]
    assert order == [n for n in scoring.SEGMENTS if n in order] and len(order) == 5


def test_churn_scores_cover_all_accounts(spark):
    df = features(spark).select("account_id", "avg_dau", "avg_mau", "arr_usd", F.col("avg_dau").alias("days_since_active"))
    labels = df.filter("avg_dau < 15").select("account_id", (F.col("avg_dau") < 2).cast("double").alias("churned"))
    scored = scoring.churn_scores(df, labels, "2024-01-31", max_iter=3)
    got = {r.account_id: r for r in scored.collect()}
    assert len(got) == 100 and all(0.0 <= r.churn_probability <= 1.0 for r in got.values())
    assert got["0-0"].churn_predicted == 1.0 and got["3-0"].churn_predicted == 0.0
    assert got["0-0"].scored_at == date(2024, 1, 31)


def test_features_fill_missing_numbers(spark):
    used = spark.createDataFrame([("a", date(2024, 1, 1), 2, 4), ("a", date(2024, 1, 3), 4, 4), ("b", date(2024, 1, 2), 1, None)],
                                 "account_id string, activity_date date, dau bigint, mau bigint")
    paid = spark.createDataFrame([("a", 5.0), ("a", 7.0), ("z", 9.0)], "account_id string, arr_usd double")
    got = {r.account_id: r for r in scoring.account_features(used, paid).collect()}
    assert (got["a"].avg_dau, got["a"].arr_usd, got["a"].dau_mau_ratio) == (3.0, 7.0, 0.75)
    assert (got["b"].avg_mau, got["b"].arr_usd, got["b"].dau_mau_ratio) == (0.0, 0.0, 1.0)
    late = {r.account_id: r.days_since_active for r in scoring.churn_features(used, paid, "2024-01-10").collect()}
    assert late == {"a": 7.0, "b": 8.0}


def test_labels_see_any_cancellation(spark):
    subs = spark.sql("""select * from values ('a', timestamp_ntz'2024-01-05 00:00:00'), ('a', null), ('b', null),
                        (null, timestamp_ntz'2024-01-05 00:00:00') t(account_id, canceled_at)""")
    assert {r.account_id: r.churned for r in scoring.churn_labels(subs).collect()} == {"a": 1.0, "b": 0.0}
    assert {r.account_id: r.churned for r in scoring.churn_labels(subs, "2024-01-06").collect()} == {"a": 0.0, "b": 0.0}
