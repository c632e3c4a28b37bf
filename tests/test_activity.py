"""Bitmaps of activity, one-pass funnels and marts kept up to date, against brute force and the plain operators."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity, chains, product
from tidemark.plans import incremental
from tidemark.session import work_dir
from tidemark.sources import landing

SCHEMA = ("event_id string, event_timestamp timestamp_ntz, event_date date, event_name string, user_id string, account_id string, "
          "session_id string")
T0 = datetime(2023, 12, 20)
NAMES = ("view", "click", "buy", "other")


@pytest.fixture(scope="module")
def events(spark):
    """Random users over 75 days, one of them with a third of all events, many at equal times."""
    rng, rows = random.Random(11), []
    for i in range(1800):
        user = "hot" if i % 3 == 0 else rng.choice([None, *[f"u{k}" for k in range(40)]])
        at = T0 + timedelta(minutes=rng.randrange(75 * 24 * 60) // 7 * 7, seconds=rng.choice([0, 0, 1, 30]))
        rows.append((str(i), at, at.date(), rng.choice(NAMES), user, f"a{rng.randrange(5)}", f"s{rng.randrange(300)}"))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


SPAN = ("2023-12-20", "2024-03-03")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 7, 30, 32])
def test_users_by_day(events, n):
    got = {r["activity_date"]: (r["dau"], r["mau"]) for r in activity.active_by_day(activity.activity_bitmaps(events, *SPAN), *SPAN, n).collect()}
    seen = {(r["user_id"], r["event_date"]) for r in events.collect() if r["user_id"]}
    first, last = date.fromisoformat(SPAN[0]), date.fromisoformat(SPAN[1])
    want = {}
    for k in range((last - first).days + 1):
        d = first + timedelta(k)
        want[d] = (len({u for u, x in seen if x == d}), len({u for u, x in seen if d - timedelta(n) < x <= d}))
    assert got == want


def test_bitmaps_merge(events):
    whole = activity.activity_bitmaps(events, *SPAN)
    parts = [activity.activity_bitmaps(events, *s) for s in (("2023-12-20", "2024-01-15"), ("2024-01-10", "2024-03-03"))]
    assert rows_of(activity.merge_bitmaps(*parts)) == rows_of(whole)
    assert whole.count() <= 41 * 4


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_retention(events, grain):
    assert rows_of(activity.retention_of(activity.activity_bitmaps(events, *SPAN), grain)) == rows_of(product.retention(events, *SPAN, grain))


def test_one_scan_and_no_window_over_events(events, spark, tmp_path):
    events.drop("event_date").withColumn("event_date", F.col("event_timestamp").cast("date")).write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    for df in (activity.active_by_day(activity.activity_bitmaps(stored, *SPAN), *SPAN),
               chains.ordered_funnel(stored, *SPAN, NAMES[:3]), chains.ordered_activation(stored, *SPAN, "view", "buy")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
    assert plan.count("Window") == 0


def test_windows_out_of_range_are_refused(events):
    bitmaps = activity.activity_bitmaps(events, *SPAN)
    for n in (0, 33):
        with pytest.raises(ValueError):
            activity.active_by_day(bitmaps, *SPAN, n)
    with pytest.raises(ValueError):
        activity.retention_of(bitmaps, "year")


@pytest.mark.parametrize("steps", [("view",), ("view", "click"), ("view", "click", "buy"), ("view", "view", "click", "buy"), ("none", "view")])
@pytest.mark.parametrize("hours", [1, 24, 2000])
def test_funnels_equal_the_joined_ones(events, steps, hours):
    assert rows_of(chains.ordered_funnel(events, *SPAN, steps, hours)) == rows_of(product.event_funnel(events, *SPAN, steps, hours))


def test_step_times_equal_a_walk_along_the_events(events):
    steps = ("view", "click", "buy")
    got = {r["user_id"]: r["reached"] for r in chains.step_times(events, *SPAN, steps).collect()}
    line = sorted((r["user_id"], r["event_timestamp"], r["event_name"]) for r in events.collect() if r["user_id"])
    want: dict = {}
    for user in {u for u, _, _ in line}:
        reached, last = [], datetime.min
        while len(reached) < len(steps):
            later = [t for u, t, n in line if u == user and n == steps[len(reached)] and t > last]
            if not later:
                break
            last = min(later)
            reached.append(int((last - datetime(1970, 1, 1)) / timedelta(microseconds=1)))
        if reached:
            want[user] = reached
    assert got == want


@pytest.mark.parametrize("hours", [0, 5, 300])
def test_activation_equals_the_joined_one(events, hours):
    assert rows_of(chains.ordered_activation(events, *SPAN, "view", "buy", hours)) == rows_of(
        product.activation_rate(events, *SPAN, "view", "buy", hours))


def test_without_events(events):
    none = events.limit(0)
    assert activity.active_by_day(activity.activity_bitmaps(none, *SPAN), *SPAN).agg(F.sum("dau"), F.count("*")).first()[:] == (0, 75)
    assert [r["users"] for r in chains.ordered_funnel(none, *SPAN, NAMES[:2]).collect()] == [0, 0]
    assert activity.retention_of(activity.activity_bitmaps(none, *SPAN)).count() == 0


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_mart_kept_up_equals_a_full_build(spark, events, tmp_path, monkeypatch):
    landed, mart = str(tmp_path / "landed"), str(tmp_path / "mart")
    spec = incremental.ENGAGEMENT
    real = events.filter("user_id is not null")
    late = F.pmod(F.xxhash64("event_id"), F.lit(20)) == 0

    def land(load, rows, at):
        landing.land_partition(rows, landed, load, at)

    def full():
        return rows_of(product.account_engagement(landing.complete_partitions(spark, landed), *SPAN))

    land("2024-01-01", real.filter(~late & (F.col("event_date") < "2024-01-01")), "2024-01-01 05:00:00")
    land("2024-02-01", real.filter(~late & F.col("event_date").between("2024-01-01", "2024-01-31")), "2024-02-01 05:00:00")
    done = incremental.refresh(spark, landed, mart, spec)
    assert [str(d) for d in done.loads] == ["2024-01-01", "2024-02-01"] and [str(p) for p in done.periods] == ["2023-12-01", "2024-01-01"]
    assert rows_of(incremental.read_mart(spark, mart)) == full()
    assert incremental.refresh(spark, landed, mart, spec) == incremental.Refreshed()
    # A month more, then late events of one old month only: the other months' files stay as they are.
    land("2024-03-04", real.filter(~late & (F.col("event_date") >= "2024-02-01")), "2024-03-04 05:00:00")
    before = files(tmp_path / "mart" / "rows")
    done = incremental.refresh(spark, landed, mart, spec)
    assert [str(d) for d in done.loads] == ["2024-03-04"] and [str(p) for p in done.periods] == ["2024-02-01", "2024-03-01"]
    assert before.items() <= files(tmp_path / "mart" / "rows").items()
    land("2024-03-05", real.filter(late & (F.col("event_date") < "2024-01-01")), "2024-03-05 05:00:00")
    scan = incremental.new_rows(spark, landed, [r["dt"] for r in incremental.new_loads(spark, landed, mart).collect()])
    assert {r[0].split("dt=")[1][:10] for r in scan.select(F.input_file_name()).distinct().collect()} == {"2024-03-05"}
    assert [str(p) for p in incremental.refresh(spark, landed, mart, spec).periods] == ["2023-12-01"]
    assert rows_of(incremental.read_mart(spark, mart)) == full()
    # The load of January arrives again without any row of it: its month is built from what other loads hold, here nothing.
    land("2024-02-01", real.filter("event_date = date '2024-02-03'").limit(3), "2024-03-06 05:00:00")
    # The first try breaks off after the parts have changed.
    real_replace = incremental._replace

    def broken(df, path, *columns):
        if path.endswith("/rows"):
            raise RuntimeError("lost")
        real_replace(df, path, *columns)

    monkeypatch.setattr(incremental, "_replace", broken)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, landed, mart, spec)
    monkeypatch.setattr(incremental, "_replace", real_replace)
    done = incremental.refresh(spark, landed, mart, spec)
    assert {str(p) for p in done.periods} == {"2024-01-01", "2024-02-01"}
    assert rows_of(incremental.read_mart(spark, mart)) == full()
    assert incremental.refresh(spark, landed, mart, spec) == incremental.Refreshed()
