from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import values
from tidemark.operators import history, skew
from workload import trust
from workload.bindings import TABLES

V = "k string, t timestamp_ntz, n int, stage string"
T = datetime


def spans(df):
    return sorted((r.k, r.stage, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_equal_versions_collapse_and_ties(spark):
    df = spark.createDataFrame([
        ("a", T(2021, 1, 1), 1, "x"), ("a", T(2021, 1, 2), 2, "x"), ("a", T(2021, 1, 3), 3, "y"),
        ("a", T(2021, 1, 3), 4, "z"), ("a", T(2021, 1, 4), 5, None), ("a", T(2021, 1, 5), 6, None),
        ("a", T(2021, 1, 6), 7, "x"), (None, T(2021, 1, 1), 1, "q")], V)
    got = spans(history.scd2_from_history(df, "k", "t", ["stage"], ["n"]).na.fill("none", ["stage"]))
    assert got == sorted([("a", "x", T(2021, 1, 1), T(2021, 1, 3), False), ("a", "z", T(2021, 1, 3), T(2021, 1, 4), False),
                          ("a", "none", T(2021, 1, 4), T(2021, 1, 6), False), ("a", "x", T(2021, 1, 6), None, True)])


@pytest.fixture(scope="module")
def versions():
    r = random.Random(5)
    return [("hot" if i % 3 == 0 else f"k{r.randrange(40)}", T(2021, 1, 1) + timedelta(hours=r.randrange(4000)), i,
             r.choice("xyz")) for i in range(900)]


def brute(versions):
    groups = defaultdict(dict)
    for k, t, n, s in sorted(versions, key=lambda v: (v[1], v[2])):
        groups[k][t] = s
    out = []
    for k, line in groups.items():
        changes = []
        for t, s in sorted(line.items()):
            if not changes or changes[-1][1] != s:
                changes.append((t, s))
        for i, (t, s) in enumerate(changes):
            end = changes[i + 1][0] if i + 1 < len(changes) else None
            out.append((k, s, t, end, end is None))
    return sorted(out, key=str)


def test_against_brute_force_with_a_heavy_key(spark, versions):
    df = spark.createDataFrame(versions, V)
    built = history.scd2_from_history(df, "k", "t", ["stage"], ["n"])
    expected = brute(versions)
    assert sorted(((r.k, r.stage, r.valid_from, r.valid_to, r.is_current) for r in built.collect()), key=str) == expected
    facts = [("hot" if i % 2 else f"k{i % 45}", T(2020, 12, 30) + timedelta(hours=7 * i), i) for i in range(600)] + [
        (None, T(2021, 2, 1), 9999)]
    found = history.as_of_lookup(spark.createDataFrame(facts, "k string, at timestamp_ntz, id int"), built, "k", "at",
                                 ["stage"]).collect()
    assert len(found) == len(facts)
    for r in found:
        valid = [s for k, s, f, t, _ in expected if k == r.k and f <= r.at and (t is None or r.at < t)]
        assert r.valid_stage == (valid[0] if valid else None)


def test_intervals_do_not_overlap(spark, versions):
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage"], ["n"])
    assert built.filter(F.col("valid_to") <= F.col("valid_from")).count() == 0
    assert built.filter("is_current").count() == built.select("k").distinct().count()


def test_merge_life_cycle(spark):
    schema = "k string, stage string, t timestamp_ntz"

    def batch(*r):
        return spark.createDataFrame(list(r), schema)

    h = history.start_history(batch(("a", "x", T(2021, 1, 1)), ("b", "x", T(2021, 1, 1))), "k", "t")
    one = batch(("a", "y", T(2021, 1, 2)), ("a", "w", T(2021, 1, 1, 12)), ("c", "x", T(2021, 1, 2)))
    h = history.scd2_merge(h, one, "k", "t", "2021-01-03")          # a changes, b vanishes, c opens
    again = history.scd2_merge(h, one, "k", "t", "2021-01-04")
    assert spans(again) == spans(h) == sorted([
        ("a", "x", T(2021, 1, 1), T(2021, 1, 2), False), ("a", "y", T(2021, 1, 2), None, True),
        ("b", "x", T(2021, 1, 1), T(2021, 1, 3), False), ("c", "x", T(2021, 1, 2), None, True)], key=str)
    older = history.scd2_merge(h, batch(("a", "old", T(2020, 1, 1)), ("c", "x", T(2021, 1, 2))), "k", "t", "2021-01-05")
    assert spans(older) == spans(h)                                  # an out-of-order update changes nothing
    back = history.scd2_merge(h, batch(("a", "y", T(2021, 1, 2)), ("b", "x", T(2021, 1, 6)), ("c", "x", T(2021, 1, 2))),
                              "k", "t", "2021-01-07")
    assert ("b", "x", T(2021, 1, 6), None, True) in spans(back)
    soft = history.scd2_merge(h, batch(("a", "y", T(2021, 1, 2))), "k", "t", "2021-01-08", hard_deletes=False)
    assert spans(soft) == spans(h)


def test_daily_rows_and_totals_agree(spark, versions):
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage"], ["n"])
    daily = history.daily_snapshot_append(built, "2021-01-05", "2021-03-01").groupBy("snapshot_date", "stage").count()
    totals = history.snapshot_totals(built, "2021-01-05", "2021-03-01", ["stage"], [])
    assert sorted(map(tuple, daily.collect())) == sorted(
        (r.snapshot_date, r.stage, r.versions) for r in totals.collect())


def test_snapshot_table_holds_runs_of_days(spark, versions, tmp_path, rows):
    """Days that are stored stay as they were, but for the last one; many days take no more rows than versions."""
    schema = "k string, stage string, n int"
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage", "n"])
    path, open_when = str(tmp_path / "snapshots"), F.col("stage") != "x"
    history.append_daily_snapshots(built, path, "2021-01-05", "2021-01-04", open_when)
    assert history.read_daily_snapshots(spark, path, schema).count() == 0
    history.append_daily_snapshots(built, path, "2021-01-05", "2021-02-10", open_when)
    before = rows(history.daily_snapshot_append(built, "2021-01-05", "2021-02-09", open_when), "k", "stage", "n", "snapshot_date")
    changed = built.withColumn("n", F.col("n") + 100)
    for end in ("2021-12-31", "2021-12-31", "2021-03-01"):
        history.append_daily_snapshots(changed, path, "2021-01-05", end, open_when)
    after = rows(history.daily_snapshot_append(changed, "2021-02-10", "2021-12-31", open_when), "k", "stage", "n", "snapshot_date")
    got = history.read_daily_snapshots(spark, path, schema).select("k", "stage", "n", "snapshot_date")
    assert sorted(map(str, rows(got))) == sorted(map(str, before + after)) and before and after
    assert spark.read.parquet(path).count() < len(before + after) / 3


def test_days_are_summed_without_decimals(spark, versions, tmp_path, rows):
    """Parts of an amount are made once per run of days; the days only add whole numbers, to the same sums."""
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage", "n"])
    priced = built.withColumn("amount", F.when(F.col("n") % 7 != 0, F.col("n") * F.lit(1234567.89)).cast("decimal(18,2)"))
    path = str(tmp_path / "snapshots")
    for end in ("2021-02-10", "2021-03-01"):
        history.append_daily_snapshots(priced, path, "2021-01-05", end)
    days = history.read_daily_snapshots(spark, path, "k string, stage string, amount decimal(18,2)",
                                        values.money_parts(F.col("amount"), "amount"))
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index(" AS amount_cents")
    totals = days.groupBy("snapshot_date", "stage").agg(F.count("*"), values.sum_of_money_parts("amount"))
    expected = history.daily_snapshot_append(priced, "2021-01-05", "2021-03-01").groupBy("snapshot_date", "stage").agg(
        F.count("*"), F.sum("amount"))
    assert rows(totals) == rows(expected)


def test_the_registered_query_adds_whole_numbers(spark, tmp_path, rows):
    lines = [(1, 1, 1, 1, 1.0, 9999999.99, 0.0, 0.0, "N", "O", T(2001, 12, 28)),
             (1, 1, 1, 2, 1.0, 10000000.01, 0.0, 0.0, "N", "F", T(2001, 12, 30)),
             (2, 1, 1, 1, 1.0, -0.07, 0.0, 0.0, "N", "F", T(2001, 12, 31)),
             (3, 1, 1, 1, 1.0, None, 0.0, 0.0, "R", "O", T(2001, 12, 31)),
             (4, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "A", "F", T(2001, 12, 1))]
    spark.createDataFrame(lines, TABLES["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    out = trust.R.queries["daily_snapshot_append"](spark, str(tmp_path))
    assert rows(out.withColumn("snapshot_date", F.dayofmonth("snapshot_date"))) == [
        (28, "NO", 1, 9999999.99), (29, "NO", 1, 9999999.99), (30, "NF", 1, 10000000.01), (31, "NF", 2, 9999999.94),
        (31, "RO", 1, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(amount_cents" in plan and "sum(amount#" not in plan


@pytest.mark.parametrize("unfolded, cells", [(1, 1), (40, 500), (1 << 18, 1 << 20)])
def test_days_are_added_up_as_they_are_unfolded(spark, versions, tmp_path, rows, monkeypatch, unfolded, cells):
    """In every size of parts the sums by batch come to the sums over the rows, groups and numbers that are null included."""
    monkeypatch.setattr(history, "_UNFOLDED", unfolded)
    monkeypatch.setattr(history, "_CELLS", cells)
    monkeypatch.setattr(skew, "UNFOLD_PARTS", 2)
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage", "n"])
    built = built.withColumn("stage", F.when(F.col("stage") != "x", F.col("stage")))
    path, schema = str(tmp_path / "snapshots"), "k string, stage string, n int"
    for end in ("2021-02-10", "2021-03-01"):
        history.append_daily_snapshots(built, path, "2021-01-05", end)
    once = {"few": F.when(F.col("n") % 3 != 0, F.col("n")), "many": F.lit(1 << 50) + F.col("n"), "none": F.lit(None)}
    for by in (["stage"], ["stage", "k"], []):
        sums = [F.sum(F.col(c).cast("bigint")).alias(c) for c in once]
        got = history.read_daily_snapshots(spark, path, schema, once, by).groupBy("snapshot_date", *by).agg(F.sum("versions"), *sums)
        expected = history.read_daily_snapshots(spark, path, schema, once).groupBy("snapshot_date", *by).agg(F.count("*"), *sums)
        assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected))) and rows(got)


def test_no_runs_add_up_to_nothing(spark, versions, tmp_path):
    built = history.scd2_from_history(spark.createDataFrame(versions, V), "k", "t", ["stage", "n"])
    path = str(tmp_path / "snapshots")
    history.append_daily_snapshots(built, path, "2021-01-05", "2021-01-04")
    assert history.read_daily_snapshots(spark, path, "k string, stage string, n int", {"m": F.col("n")}, ["stage"]).count() == 0


def test_the_registered_query_looks_up_no_group_per_day(spark, tmp_path, rows):
    lines = [(1, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "O", T(2001, 12, 30)), (2, 1, 1, 1, 1.0, 0.5, 0.0, 0.0, "N", "O", T(2001, 12, 31))]
    spark.createDataFrame(lines, TABLES["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    out = trust.R.queries["daily_snapshot_append"](spark, str(tmp_path))
    assert rows(out.withColumn("snapshot_date", F.dayofmonth("snapshot_date"))) == [(30, "NO", 1, 5.0), (31, "NO", 2, 5.5)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert [f.nullable for f in out.schema] == [False, True, False, True]
