"""Streaming queries: each runs a stream to the end of its input and reads its output.

The SQL counterpart is the batch twin over all events; windows and sessions still open count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.relational import not_in_events
from tidemark.session import work_dir
from tidemark.streaming import events as streams
from workload.bindings import BINDINGS, TABLES
from workload.context import Registry

R = Registry()


def _stream(c) -> DataFrame:
    raw = streams.stream_events(c.spark, c.sf_dir, TABLES["events"], "events.parquet")
    return raw.selectExpr(*[f"{e} as {n}" for n, e in BINDINGS["raw_event"].columns.items()])


def _run(c, df: DataFrame, purpose: str) -> DataFrame:
    return streams.run_available(df, work_dir(c.spark, purpose))


def _keyed(c, df: DataFrame, purpose: str, keys, order=(), mode: str = "update") -> DataFrame:
    return streams.run_upserts(df, work_dir(c.spark, purpose), keys, order, mode)


R.add("stream_events", lambda c: _run(c, _stream(c), "stream-events"), "select * from raw_event")
R.add("stream_daily_engagement", lambda c: streams.daily_engagement(_keyed(
    c, streams.stream_activity(streams.timed(_stream(c))), "stream-dau", streams.ACTIVITY_KEYS)), """
    select event_date as activity_date, account_id, count(distinct user_id) as dau, count(*) as event_count,
           count(distinct session_id) as sessions, count(distinct event_name) as features
    from e_active group by 1, 2""")


def _approx(c) -> DataFrame:
    """The sketched counts beside how far they may be off: three standard errors, one at least."""
    found = _keyed(c, streams.stream_engagement_approx(streams.timed(_stream(c))), "stream-approx",
                   ["activity_date", "account_id"])
    exact = not_in_events(c.raw["raw_event"]).groupBy(F.col("event_date").alias("activity_date"), "account_id").agg(
        F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("dau") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * 0.06)
    return found.join(exact, ["activity_date", "account_id"], "left").select(
        "activity_date", "account_id", "event_count", near.alias("dau_near"),
        (F.col("sessions") > 0).alias("has_sessions"))


R.add("stream_engagement_approx", _approx, """
    select event_date as activity_date, account_id, count(*) as event_count, true as dau_near,
           count(session_id) > 0 as has_sessions
    from e_active group by 1, 2""")


def _twice(c) -> DataFrame:
    """The stream as an at-least-once source delivers it: every event comes twice."""
    return streams.timed(_stream(c)).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


R.add("stream_dedupe", lambda c: _run(c, streams.stream_dedupe(_twice(c)), "stream-dedupe").select(
    "event_id", "event_timestamp", "user_id"), "select event_id, event_timestamp, user_id from raw_event")
R.add("stream_sessions", lambda c: streams.sessions(_keyed(
    c, streams.stream_slots(streams.timed(_stream(c))), "stream-sessions", streams.SLOT_KEYS)), """
    with o as (select *, lag(event_timestamp) over (partition by user_id order by event_timestamp) as p from raw_event),
    n as (select *, sum(case when p is null or event_timestamp - p > interval 30 minute then 1 else 0 end)
                    over (partition by user_id order by event_timestamp range unbounded preceding) as s from o)
    select user_id, min(event_timestamp) as session_start, max(event_timestamp) as session_end,
           count(*) as events from n group by user_id, s""")
# The last event of each user, kept up to date by the stream.
R.add("stream_upsert", lambda c: _keyed(
    c, _stream(c).select("user_id", "event_timestamp", "event_id", "event_name"), "stream-upsert", ["user_id"],
    ["event_timestamp", "event_id"], "append"), """
    select user_id, event_timestamp, event_id, event_name from (
        select *, row_number() over (partition by user_id order by event_timestamp desc, event_id desc) as rn
        from raw_event) where rn = 1""")
R.add("stream_anomaly", lambda c: streams.anomalies(
    _keyed(c, streams.stream_windows(streams.timed(_stream(c))), "stream-anomaly", streams.WINDOW_KEYS),
    streams.hourly_baseline(c.raw["raw_event"]), 2.5).withColumn("z_score", F.round("z_score", 6)), """
    with h as (select event_name, date_trunc('hour', event_timestamp) as h, count(*) as n from raw_event group by 1, 2),
    b as (select event_name, avg(n) as m, stddev_samp(n) as s from h group by 1),
    w as (select time_bucket(interval 15 minute, event_timestamp) - to_minutes(15 * k) as window_start, event_name,
                 count(*) as events from raw_event cross join range(0, 4) r(k) group by 1, 2)
    select w.window_start, w.event_name, w.events, round((events - m) / nullif(s, 0), 6) as z_score
    from w join b on b.event_name = w.event_name
    where abs((events - m) / nullif(s, 0)) > 2.5""")
R.add("hourly_baseline", lambda c: streams.hourly_baseline(c.raw["raw_event"]).select(
    "event_name", "mean_events", F.round("sd_events", 9).alias("sd_events")), """
    select event_name, cast(sum(n) as double) / count(*) as mean_events, round(stddev_samp(n), 9) as sd_events
    from (select event_name, date_trunc('hour', event_timestamp) as h, count(*) as n from raw_event group by 1, 2)
    group by 1""")
# Events arrive 0 to 4 hours after they happen.
_ARRIVAL = "event_timestamp + cast(cast(event_id as bigint) % 5 as int) * interval '1' hour"
R.add("late_events", lambda c: streams.late_events(
    c.raw["raw_event"].selectExpr("event_id", "event_timestamp", f"{_ARRIVAL} as arrived_at"),
    "arrived_at", "event_timestamp", "1 hour"), f"""
    with a as (select event_id, event_timestamp, {_ARRIVAL} as arrived_at from raw_event),
    b as (select date_trunc('hour', arrived_at) as b, max(event_timestamp) as m from a group by 1),
    w as (select b, max(m) over (order by b rows between unbounded preceding and 1 preceding) - interval 1 hour
                 as watermark from b)
    select event_id, event_timestamp, arrived_at, watermark from a join w on w.b = date_trunc('hour', arrived_at)
    where event_timestamp < watermark""")
