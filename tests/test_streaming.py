from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tidemark.session import work_dir
from tidemark.streaming import events as streams

SCHEMA = ("event_id string, event_timestamp timestamp_ntz, event_name string, user_id string, account_id string, "
          "session_id string")
T0 = datetime(2024, 1, 1)


def batch(spark, path, rows):
    spark.createDataFrame([(i, t, n, u, "a", f"{u}-1") for i, t, n, u in rows], SCHEMA).coalesce(1).write.mode(
        "append").parquet(path)


def test_engagement_over_several_batches_with_late_and_repeated_events(spark):
    path = work_dir(spark, "in")
    batch(spark, path, [("1", T0, "view", "u1"), ("2", T0 + timedelta(hours=1), "view", "u1"),
                        ("3", T0 + timedelta(hours=23), "view", "u2")])
    batch(spark, path, [("4", T0 + timedelta(hours=22, minutes=30), "view", "u3"),     # late, inside the delay
                        ("5", T0 + timedelta(hours=26), "view", "u1"),
                        ("3", T0 + timedelta(hours=23), "view", "u2")])
    batch(spark, path, [("6", T0 + timedelta(hours=50), "view", "u1")])
    stream = streams.timed(streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1))
    got = streams.daily_engagement(streams.run_upserts(
        streams.stream_activity(stream), work_dir(spark, "out"), streams.ACTIVITY_KEYS)).collect()
    assert sorted((r.activity_date.day, r.dau, r.event_count) for r in got) == [(1, 3, 5), (2, 1, 1), (3, 1, 1)]
    unique = streams.run_available(streams.stream_dedupe(streams.timed(
        streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1), delay="3 days")), work_dir(spark, "out"))
    assert unique.count() == 6


def test_a_restart_reads_only_new_files(spark):
    path, out = work_dir(spark, "in"), work_dir(spark, "out")
    batch(spark, path, [("1", T0, "view", "u1")])
    stream = streams.stream_events(spark, path, SCHEMA)
    assert streams.run_available(stream, out).count() == 1
    batch(spark, path, [("2", T0, "view", "u1")])
    assert streams.run_available(streams.stream_events(spark, path, SCHEMA), out).count() == 2


def test_the_last_row_of_each_key_over_several_batches(spark):
    path, out = work_dir(spark, "in"), work_dir(spark, "out")
    batch(spark, path, [("1", T0, "x", "a"), ("2", T0, "x", "b"), ("3", T0 + timedelta(hours=2), "y", "a")])
    run = lambda: {r.user_id: r.event_name for r in streams.run_upserts(
        streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1), out, ["user_id"],
        ["event_timestamp", "event_id"], "append").collect()}
    assert run() == {"a": "y", "b": "x"}
    batch(spark, path, [("4", T0 + timedelta(hours=1), "old", "a"), ("5", T0 + timedelta(hours=5), "new", "b"),
                        ("6", T0, "c", "c")])
    assert run() == {"a": "y", "b": "new", "c": "c"}
    assert run() == {"a": "y", "b": "new", "c": "c"}


def test_sessions_over_batches_and_slots(spark):
    path = work_dir(spark, "in")
    at = lambda minutes: T0 + timedelta(minutes=minutes)
    batch(spark, path, [("1", at(0), "v", "u"), ("2", at(29), "v", "u"), ("3", at(59), "v", "u")])
    batch(spark, path, [("4", at(90), "v", "u"), ("5", at(91), "v", "w")])
    slots = streams.run_upserts(streams.stream_slots(streams.timed(
        streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1), delay="3 hours")), work_dir(spark, "out"), streams.SLOT_KEYS)
    got = sorted((r.user_id, r.session_start, r.session_end, r.events) for r in streams.sessions(slots).collect())
    assert got == [("u", at(0), at(59), 3), ("u", at(90), at(90), 1), ("w", at(91), at(91), 1)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    path = work_dir(spark, "in")
    batch(spark, path, [("1", T0 + timedelta(minutes=5), "view", "u1"), ("2", T0 + timedelta(hours=23, minutes=50), "view", "u2"),
                        ("3", T0 + timedelta(days=3), "view", "u1")])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stream = streams.timed(streams.stream_events(spark, path, SCHEMA))
        got = streams.daily_engagement(streams.run_upserts(
            streams.stream_activity(stream), work_dir(spark, "out"), streams.ACTIVITY_KEYS)).collect()
        assert sorted((r.activity_date.day, r.dau) for r in got) == [(1, 2), (4, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _folders(spark, out):
    return (streams._numbered(spark, f"{out}/data", "batch"), streams._numbered(spark, f"{out}/compacted", "upto", whole=True))


def test_batches_are_compacted_over_restarts_and_reads_take_later_ones_only(spark):
    path, out = work_dir(spark, "in"), work_dir(spark, "out")
    schema, order, expected = None, ["event_timestamp", "event_id"], {}
    for run in range(3):
        for k in range(4):
            rows = [(f"{run}{k}{n}", T0 + timedelta(minutes=(run * 7 + k * 11 + n * 5) % 23), f"{run}-{k}", f"u{(n + k) % 5}") for n in range(4)]
            batch(spark, path, rows)
            for i, t, name, user in rows:
                expected[user] = max(expected.get(user, (datetime.min, "", "")), (t, i, name))
        stream = streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1)
        schema = stream.schema
        found = streams.run_upserts(stream, out, ["user_id"], order, "append", compact_every=2)
        assert {r.user_id: (r.event_timestamp, r.event_id, r.event_name) for r in found.collect()} == expected
    batches, compactions = _folders(spark, out)
    assert compactions == [7, 9] and batches == [-1, 8, 9, 10, 11]
    # What the last compaction replaced is not read: the newest rows of all are hidden in an old batch.
    spark.createDataFrame([("z", datetime(2030, 1, 1), "wrong", "u1", "a", "u1-1")], SCHEMA).write.parquet(f"{out}/data/batch=3")
    found = streams.read_upserts(spark, schema, out, ["user_id"], order)
    assert {r.user_id: r.event_name for r in found.collect()} == {u: v[2] for u, v in expected.items()}


def test_a_compaction_that_broke_off_does_not_count(spark):
    path, out = work_dir(spark, "in"), work_dir(spark, "out")
    for k in range(3):
        batch(spark, path, [(str(k), T0 + timedelta(hours=k), f"n{k}", "u")])
    stream = streams.stream_events(spark, path, SCHEMA, max_files_per_trigger=1)
    read = lambda: [r.event_name for r in streams.read_upserts(spark, stream.schema, out, ["user_id"], ["event_timestamp"]).collect()]
    streams.run_upserts(stream, out, ["user_id"], ["event_timestamp"], "append")
    assert _folders(spark, out) == ([-1, 0, 1, 2], [])
    half = f"{out}/compacted/upto=2"
    spark.createDataFrame([], stream.schema).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert _folders(spark, out)[1] == [] and read() == ["n2"]
    streams.compact_upserts(spark, stream.schema, out, ["user_id"], ["event_timestamp"], 2)
    assert _folders(spark, out)[1] == [2] and read() == ["n2"]
    # Once more changes nothing.
    streams.compact_upserts(spark, stream.schema, out, ["user_id"], ["event_timestamp"], 2)
    assert _folders(spark, out) == ([-1, 0, 1, 2], [2]) and read() == ["n2"]
