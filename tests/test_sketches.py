from __future__ import annotations

import random
from bisect import bisect_left, bisect_right
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.plans import incremental, metrics
from tidemark.session import work_dir
from tidemark.sources import landing

EVENT = "event_date date, account_id string, user_id string, event_name string"


@pytest.fixture(scope="module")
def seen():
    rng = random.Random(4)
    rows = [(date(2024, 1, 1) + timedelta(rng.randrange(120)), f"a{rng.randrange(9) if rng.random() < 0.6 else 0}",
             f"u{int(rng.paretovariate(0.4)) % 5000}", "view") for _ in range(20000)]
    return rows + [(date(2024, 1, 3), None, "u1", "view"), (date(2024, 1, 3), "a1", None, "view"),
                   (date(2024, 1, 3), "a1", "only_start", "session_start")]


def _exact(seen, key):
    users = {}
    for d, a, u, name in seen:
        if a is not None and u is not None and name == "view":
            users.setdefault(key(d, a), set()).add(u)
    return {k: len(v) for k, v in users.items()}


@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter", "year"])
def test_users_of_any_period_and_group_lie_within_three_standard_errors(spark, seen, grain):
    parts = sketches.distinct_parts(spark.createDataFrame(seen, EVENT))
    accounts = spark.createDataFrame([(f"a{k}", f"g{k % 2}") for k in range(8)], "account_id string, grp string")
    start = {"day": lambda d: d, "week": lambda d: d - timedelta(d.weekday()), "month": lambda d: d.replace(day=1),
             "quarter": lambda d: d.replace(month=(d.month - 1) // 3 * 3 + 1, day=1), "year": lambda d: d.replace(month=1, day=1)}[grain]
    group = lambda a: None if a == "a8" else f"g{int(a[1:]) % 2}"
    for dims, key in (((), lambda d, a: (start(d),)), (("grp",), lambda d, a: (start(d), group(a))),
                      (("account_id",), lambda d, a: (start(d), a))):
        exact = _exact(seen, key)
        found = metrics.distinct_metric(parts, accounts, grain, dims).collect()
        assert {(r.period, *[r[x] for x in dims]) for r in found} == set(exact)
        for r in found:
            n = exact[(r.period, *[r[x] for x in dims])]
            assert abs(r.value - n) <= 3 * sketches.standard_error() * n
            assert r.approximate and r.metric == "active_users" and r.standard_error == r.value * sketches.standard_error()


def test_loads_unite_and_metrics_read_no_events(spark, seen):
    landed, mart = work_dir(spark, "landed"), work_dir(spark, "mart")
    events = spark.createDataFrame(seen, EVENT)
    half = F.pmod(F.hash("user_id", "event_date"), F.lit(3)) == 0
    for load, rows in (("2024-05-01", events.filter(half)), ("2024-05-02", events.filter(~half | half.isNull()))):
        landing.land_partition(rows, landed, load, f"{load} 01:00:00")
        incremental.refresh(spark, landed, mart, incremental.ACTIVE_USERS)
    # The same load once more changes nothing.
    landing.land_partition(events.filter(half), landed, "2024-05-01", "2024-05-03 01:00:00")
    assert incremental.refresh(spark, landed, mart, incremental.ACTIVE_USERS).loads == [date(2024, 5, 1)]
    stored = incremental.read_mart(spark, mart)
    assert stored.groupBy("activity_date", "account_id").count().filter("count > 1").count() == 0
    found = metrics.distinct_metric(stored, None, "month")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and plan.count("FileScan") == 1
    exact = _exact(seen, lambda d, a: d.replace(day=1))
    assert {r.period for r in found.collect()} == set(exact)
    assert all(abs(r.value - exact[r.period]) <= 3 * sketches.standard_error() * exact[r.period] for r in found.collect())


def test_empty_events_and_wrong_grains(spark):
    parts = sketches.distinct_parts(spark.createDataFrame([], EVENT))
    assert metrics.distinct_metric(parts, None, "quarter").count() == 0
    with pytest.raises(ValueError):
        metrics.distinct_metric(parts, None, "decade")
    none = sketches.quantile_parts(spark.createDataFrame([], "d date, v int"), F.col("v"), F.col("d"))
    assert sketches.quantiles(none, "year", [0.5]).count() == 0
    for grain, p in (("day", 0.5), ("year", 1.5)):
        with pytest.raises(ValueError):
            sketches.quantiles(none, grain, [p])


def test_quantiles_of_united_months_keep_their_rank(spark):
    rng = random.Random(9)
    rows = [(date(2023, 1, 1) + timedelta(rng.randrange(730)), rng.choice("xyz") if rng.random() < 0.3 else "x",
             None if rng.random() < 0.02 else int(rng.lognormvariate(4, 1.5))) for _ in range(60000)]
    df = spark.createDataFrame(rows, "d date, g string, v int")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    parts = sketches.quantile_parts(df, F.col("v"), F.col("d"), ["g"])
    for grain, start in (("year", lambda d: date(d.year, 1, 1)), ("quarter", lambda d: date(d.year, (d.month - 1) // 3 * 3 + 1, 1))):
        for by in ((), ("g",)):
            values = {}
            for d, g, v in rows:
                if v is not None:
                    values.setdefault((start(d), *([g] if by else [])), []).append(v)
            found = sketches.quantiles(parts, grain, wanted, by).collect()
            assert len(found) == len(values) * len(wanted)
            for r in found:
                own = sorted(values[(r.period, *[r[x] for x in by])])
                assert r.n == len(own)
                low, high = bisect_left(own, r.value) / len(own), bisect_right(own, r.value) / len(own)
                assert low - r.rank_error <= r.probability <= high + r.rank_error


def test_few_values_are_exact(spark):
    df = spark.createDataFrame([(date(2023, 1 + k % 3, 1), k) for k in range(101)], "d date, v int")
    found = sketches.quantiles(sketches.quantile_parts(df, F.col("v"), F.col("d")), "year", [0.0, 0.5, 1.0]).collect()
    assert sorted((r.probability, r.value) for r in found) == [(0.0, 0), (0.5, 50), (1.0, 100)]
