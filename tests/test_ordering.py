"""Ordered scans and salted joins against brute force, with a key that owns a third of the rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering, skew
from tidemark.operators.product import event_funnel, rolling_distinct, session_ids, sessionize

START = datetime(2024, 1, 1)


def make(n=3000, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{r.randrange(200)}")
        out.append((i, key, START + timedelta(minutes=r.randrange(60 * 24 * 20)), r.choice([None, 1, 2, 3])))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(make(), "id int, k string, t timestamp_ntz, v int").repartition(7).cache()


def by_key():
    groups = defaultdict(list)
    for row in make():
        if row[1] is not None:
            groups[row[1]].append(row)
    return {k: sorted(v, key=lambda x: (x[2], x[0])) for k, v in groups.items()}


def test_hot_key_is_found(frame):
    assert "hot" in [r.k for r in skew.hot_keys(frame, "k").collect()]


@pytest.mark.parametrize("width", ["hour", "day"])
def test_neighbours(frame, width):
    previous = {r.id: (r.has_previous, r.previous_v, r.previous_id) for r in
                ordering.with_previous(frame, "k", ["t", "id"], ["v", "id"], width).collect()}
    following = {r.id: (r.has_next, r.next_v) for r in ordering.with_next(frame, "k", ["t", "id"], ["v"], width).collect()}
    assert len(previous) == len(following) == 3000
    for group in by_key().values():
        for i, row in enumerate(group):
            before = group[i - 1] if i else None
            after = group[i + 1] if i + 1 < len(group) else None
            assert previous[row[0]] == ((True, before[3], before[0]) if before else (False, None, None))
            assert following[row[0]] == ((True, after[3]) if after else (False, None))
    for row in make():
        if row[1] is None:
            assert previous[row[0]][0] is False and following[row[0]][0] is False


def test_running(frame):
    carried = {r.id: r.c for r in ordering.carry_forward(frame, "k", ["t", "id"], F.col("v"), "c").collect()}
    totals = {r.id: r.s for r in ordering.running_total(frame, "k", ["t", "id"], F.col("v"), "s").collect()}
    for group in by_key().values():
        last, total = None, None
        for row in group:
            if row[3] is not None:
                last, total = row[3], (total or 0) + row[3]
            assert carried[row[0]] == last and totals[row[0]] == total


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, frame, how):
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4), (None, 5)], "k string, w int")
    a = Counter(map(tuple, skew.spread_join(frame, small, "k", how).select(*frame.join(small, "k", how).columns).collect()))
    assert a == Counter(map(tuple, frame.join(small, "k", how).collect()))


def events(spark, rows):
    return spark.createDataFrame(
        [(str(i), u, n, t, t.date()) for i, (u, n, t) in enumerate(rows)],
        "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz, event_date date")


def test_session_border(spark):
    t = datetime(2024, 1, 1, 10, 0)
    step = timedelta(minutes=30)
    stamps = [t, t + step - timedelta(seconds=1), t + 2 * step - timedelta(seconds=1),
              t + 3 * step + timedelta(seconds=0), t + 4 * step + timedelta(seconds=1)]
    # gaps: 29:59, 30:00 exactly (same session), 30:01 and 30:01 (new sessions)
    df = events(spark, [("u", "x", s) for s in stamps])
    got = sorted((r.session_number, r.events) for r in sessionize(df, "2024-01-01", "2024-01-02").collect())
    assert got == [(1, 3), (2, 1), (3, 1)]
    assert sorted((int(r.event_id), r.session_number) for r in session_ids(df, "2024-01-01", "2024-01-02").collect()) == [
        (0, 1), (1, 1), (2, 1), (3, 2), (4, 3)]


def test_rolling_distinct_brute_force(spark):
    r = random.Random(3)
    rows = [(f"u{r.randrange(12)}", "x", START + timedelta(days=r.randrange(25), minutes=i)) for i in range(80)]
    got = {x.activity_date: x.mau for x in rolling_distinct(events(spark, rows), "2024-01-01", "2024-01-30", 5).collect()}
    assert len(got) == 30
    for d, mau in got.items():
        assert mau == len({u for u, _, t in rows if 0 <= (d - t.date()).days < 5})


def test_funnel_order_and_limit(spark):
    t = datetime(2024, 1, 1)
    h = timedelta(hours=1)
    df = events(spark, [("a", "view", t), ("a", "click", t + h), ("a", "buy", t + 2 * h),
                        ("b", "click", t), ("b", "view", t + h), ("b", "buy", t + 2 * h),
                        ("c", "view", t), ("c", "click", t + h), ("c", "buy", t + 30 * h), (None, "view", t)])
    got = [(r.step, r.users) for r in event_funnel(df, "2024-01-01", "2024-01-05", ["view", "click", "buy"], 24)
           .orderBy("step").collect()]
    assert got == [(1, 3), (2, 2), (3, 1)]
