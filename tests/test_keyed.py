"""Stored tables by key bucket: what a merge reads and rewrites, and that it can be repeated."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.session import work_dir
from tidemark.sources import keyed, landing

SCHEMA = "id bigint, stage string, at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def rows(n, seed, keys=60):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(keys)]) if rng.random() < 0.1 else rng.randrange(keys), rng.choice("abc"),
             T0 + timedelta(hours=rng.randrange(50))) for _ in range(n)]


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def first(spark, seed=1):
    return landing.merge_upsert(spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows(100, seed), SCHEMA), ["id"], "at")


@pytest.mark.parametrize("buckets", [1, 8])
def test_merges_equal_upserts_of_whole_tables(spark, buckets):
    path, whole = work_dir(spark, "keyed"), first(spark)
    keyed.create_keyed(whole, path, ["id"], buckets)
    for seed in (2, 3):
        batch = spark.createDataFrame(rows(30, seed), SCHEMA)
        whole = spark.createDataFrame(landing.merge_upsert(whole, batch, ["id"], "at").collect(), SCHEMA)
        keyed.merge_into(batch, path, "at")
        assert as_set(keyed.read_keyed(spark, path)) == as_set(whole)


def test_a_batch_in_one_bucket_reads_and_writes_one_partition(spark):
    path = work_dir(spark, "keyed")
    keyed.create_keyed(first(spark).filter("id is not null"), path, ["id"], 8)
    before = files(f"{path}/rows")
    batch = spark.createDataFrame([(7, "new", T0 + timedelta(days=9))], SCHEMA)
    bucket = batch.select(keyed.bucket_of(["id"], 8)).first()[0]
    assert keyed.merge_into(batch, path, "at") == [bucket]
    after = files(f"{path}/rows")
    changed = {f for f in before.keys() ^ after.keys()} | {f for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed and all(f"_bucket={bucket}/" in f for f in changed)
    scan = keyed.read_keyed(spark, path, [bucket])
    read = {r[0] for r in scan.select(F.input_file_name()).distinct().collect()}
    assert read and all(f"_bucket={bucket}/" in f for f in read)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"(_bucket#" in plan.split("PartitionFilters")[1]
    assert keyed.read_keyed(spark, path).filter("id = 7").first()["stage"] == "new"


def test_nothing_and_the_same_again_change_nothing(spark):
    path = work_dir(spark, "keyed")
    keyed.create_keyed(first(spark), path, ["id"], 8)
    batch = spark.createDataFrame([r for r in rows(30, 5) if r[0] is not None], SCHEMA)
    keyed.merge_into(batch, path, "at")
    once, kept = as_set(keyed.read_keyed(spark, path)), files(path)
    assert keyed.merge_into(batch.limit(0), path, "at") == [] and files(path) == kept
    keyed.merge_into(batch.withColumnRenamed("stage", "STAGE").withColumn("extra", F.lit(1)), path, "at")
    assert as_set(keyed.read_keyed(spark, path)) == once


def test_two_keys_and_an_empty_table(spark):
    schema = "a string, b int, v string, at timestamp_ntz"
    path = work_dir(spark, "keyed")
    keyed.create_keyed(spark.createDataFrame([], schema), path, ["a", "b"], 4)
    assert keyed.read_keyed(spark, path).collect() == []
    keyed.merge_into(spark.createDataFrame([("x", 1, "u", T0), ("x", 2, "v", T0), ("x", 1, "w", T0 + timedelta(1))], schema), path, "at")
    assert as_set(keyed.read_keyed(spark, path).select("a", "b", "v")) == [("x", 1, "w"), ("x", 2, "v")]


SNAP = "k bigint, stage string, t timestamp_ntz"


def snapshot(spark, seed, day, share):
    rng = random.Random(seed)
    return spark.createDataFrame([(k, rng.choice("abc"), T0 + timedelta(days=day - rng.randrange(2), hours=k))
                                  for k in range(40) if rng.random() < share], SNAP)


@pytest.mark.parametrize("hard", [False, True])
def test_stored_histories_equal_merges_in_memory(spark, hard):
    path = work_dir(spark, "history")
    start = snapshot(spark, 1, 1, 0.7)
    keyed.create_history(start, path, "k", "t", 8)
    whole = history.start_history(start, "k", "t")
    for seed, day in ((2, 4), (3, 7), (4, 9)):
        batch, as_of = snapshot(spark, seed, day, 0.6 if hard else 0.2), f"2024-01-{day + 2:02d}"
        merged = history.scd2_merge(whole, batch, "k", "t", as_of, hard)
        whole = spark.createDataFrame(merged.collect(), merged.schema)
        keyed.merge_history(batch, path, "t", as_of, hard)
        names = whole.columns
        assert as_set(keyed.read_history(spark, path).select(*names)) == as_set(whole)
        before = as_set(keyed.read_history(spark, path))
        keyed.merge_history(batch, path, "t", as_of, hard)
        assert as_set(keyed.read_history(spark, path)) == before
    with pytest.raises(ValueError, match="forward"):
        keyed.merge_history(batch, path, "t", "2024-01-01", hard)


def test_a_history_merge_touches_its_buckets_only(spark):
    path = work_dir(spark, "history")
    keyed.create_history(snapshot(spark, 1, 1, 1.0), path, "k", "t", 8)
    before = files(f"{path}/open")
    batch = spark.createDataFrame([(7, "z", T0 + timedelta(days=9))], SNAP)
    touched = keyed.merge_history(batch, path, "t", "2024-01-11")
    assert len(touched) == 1
    after = files(f"{path}/open")
    assert {f.split("_bucket=")[1].split("/")[0] for f in before.keys() ^ after.keys()} == {str(touched[0])}


def test_a_broken_merge_goes_on(spark, monkeypatch):
    path = work_dir(spark, "history")
    start, batch = snapshot(spark, 1, 1, 1.0), snapshot(spark, 2, 5, 0.6)
    keyed.create_history(start, path, "k", "t", 4)
    want = as_set(history.scd2_merge(history.start_history(start, "k", "t"), batch, "k", "t", "2024-01-08", True))
    real = keyed._replace

    def broken(df, folder, column=keyed.BUCKET):
        if folder.endswith("/open"):
            # Half of the buckets are replaced before the machine goes down.
            real(df.filter(F.col(column) < 2), folder, column)
            raise RuntimeError("lost")
        real(df, folder, column)

    monkeypatch.setattr(keyed, "_replace", broken)
    with pytest.raises(RuntimeError):
        keyed.merge_history(batch, path, "t", "2024-01-08", True)
    monkeypatch.setattr(keyed, "_replace", real)
    keyed.merge_history(batch, path, "t", "2024-01-08", True)
    names = ["k", "stage", "t", "valid_from", "valid_to", "is_current"]
    assert as_set(keyed.read_history(spark, path).select(*names)) == want
