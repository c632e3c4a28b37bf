from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import masks, values
from tidemark.functions.dates import period_start
from tidemark.operators import calendar, governance, people, quality, relational, sales
from tidemark.operators.quality import Between, NotNull, Unique
from tidemark.operators.relational import latest_by_key
from tidemark.session import work_dir
from tidemark.sources import landing, registry


def one(df):
    return tuple(df.first())


def test_masks(spark):
    texts = spark.createDataFrame([(None,), ("",), ("nobody",), ("a@b.c",), ("a@b@c.d",)], "e string")
    got = [r[0] for r in texts.select(masks.mask_email(F.col("e"), "analyst")).collect()]
    assert got == [None, "", "nobody", "***@b.c", "***@c.d"]
    strict = [r[0] for r in texts.select(masks.mask_email(F.col("e"), "analyst", strict=True)).collect()]
    assert strict == [None, "***", "***", "***@b.c", "***@c.d"]
    assert [r[0] for r in texts.select(masks.mask_email(F.col("e"), "engineer")).collect()] == [
        None, "", "nobody", "a@b.c", "a@b@c.d"]
    phones = spark.createDataFrame([(None,), ("12",), ("555-010-1234",)], "p string")
    assert [r[0] for r in phones.select(masks.mask_phone(F.col("p"), "engineer")).collect()] == [
        None, "***-***-12", "***-***-1234"]
    money = spark.createDataFrame([(Decimal("1.50"), "x"), (None, None)], "m decimal(18,2), i string")
    out = money.select(masks.mask_amount(F.col("m"), "analyst").alias("m"), masks.mask_id(F.col("i"), "analyst").alias("i"))
    assert dict(out.dtypes)["m"] == "decimal(18,2)"
    assert [r.m for r in out.collect()] == [None, None]
    assert [r.i and len(r.i) for r in out.collect()] == [64, None]


def test_row_access(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "id string, territory_id string")
    own = spark.createDataFrame([("me", "1"), ("me", "9"), ("you", "2")], "user_email string, territory_id string")
    assert governance.row_access(df, "sales", "me", own).count() == 1
    assert governance.row_access(df, "sales", "stranger", own).count() == 0
    assert governance.row_access(df, "admin", "stranger", own).count() == 3


def test_policies_need_known_tags(spark):
    with pytest.raises(ValueError):
        governance.tag_columns(spark.range(1), {"id": {"classification": "secret"}})


def test_erasure_keeps_rows_without_subject(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, n int")
    ids = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "id string")
    assert sorted(r.n for r in governance.erase_subjects(df, "s", ids).collect()) == [2, 3]


def test_null_rules_of_tests(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (None, 5), (None, -1)], "k int, v int")
    assert quality.unique(df, "k").collect()[0].n_records == 2
    assert quality.between(df, "v", 0, 10).count() == 1
    assert quality.not_null(df, "k").count() == 2
    suite = quality.run_suite({"t": df}, {"t": [NotNull("k"), NotNull("v"), Between("v", 0), Unique(("k",)),
                                                 Unique(("v",))]}, {"t": 1})
    assert {r.test_name: (r.failures, r.status) for r in suite.collect()} == {
        "not_null_k": (2, "fail"), "not_null_v": (1, "fail"), "between_v": (1, "fail"), "unique_k": (1, "fail"),
        "unique_v": (1, "fail")}
    empty = quality.run_suite({"t": df.limit(0)}, {"t": [NotNull("k"), Unique(("k",))]}, {})
    assert {(r.failures, r.status, r.tier) for r in empty.collect()} == {(0, "pass", 3)}


@pytest.mark.parametrize("as_of,status", [("2021-01-01 12:00:00", "pass"), ("2021-01-01 12:00:01", "warn"),
                                          ("2021-01-02 00:00:00", "warn"), ("2021-01-02 00:00:01", "error")])
def test_freshness_borders(spark, as_of, status):
    df = spark.createDataFrame([(datetime(2021, 1, 1),)], "t timestamp_ntz")
    assert quality.freshness({"s": df}, "t", as_of).first().status == status
    assert quality.freshness({"s": df.limit(0)}, "t", as_of).first().status == "error"


def test_win_rate_with_unknown_outcome_and_no_wins(spark):
    schema = "close_date date, is_closed boolean, is_won boolean, amount_usd decimal(18,2)"
    df = spark.createDataFrame([(date(2021, 1, 5), True, None, Decimal("5")), (date(2021, 1, 6), True, False, Decimal("5")),
                                (date(2021, 2, 6), None, True, Decimal("5"))], schema)
    r = sales.win_rate(df).first()
    assert (r.won_count, r.lost_count, r.closed_count, r.win_rate, r.avg_deal_size_usd) == (0, 1, 2, 0.0, None)
    assert sales.win_rate(df.limit(0)).count() == 0


def test_cents_are_exact(spark):
    df = spark.createDataFrame([(1,), (105,), (-7,), (None,), (9007199254740993,)], "c bigint")
    assert [r[0] for r in df.select(values.cents_to_dollars(F.col("c"))).collect()] == [
        Decimal("0.01"), Decimal("1.05"), Decimal("-0.07"), None, Decimal("90071992547409.93")]


def test_money_parts_add_up_to_the_sum_of_decimals(spark):
    most = "9999999999999999.99"
    amounts = [("a", "0.01"), ("a", "-0.02"), ("a", "10000000.00"), ("a", "-10000000.01"), ("a", "9999999.99"), ("a", None),
               ("most", most), ("most", most), ("most", most), ("least", "-" + most), ("least", "-" + most),
               ("none", None), ("none", None), ("zero", "0.00"), ("zero", None)]
    df = (spark.createDataFrame([(k, m and Decimal(m)) for k, m in amounts * 20], "k string, m decimal(18,2)")
          .withColumns(values.money_parts(F.col("m"), "m")))
    got = df.groupBy("k").agg(values.sum_of_money_parts("m").alias("parts"), F.sum("m").alias("whole"))
    assert got.schema["parts"].dataType == got.schema["whole"].dataType
    assert len(rows := got.collect()) == 5 and all(r.parts == r.whole for r in rows)
    assert {r.k: r.parts for r in rows}["none"] is None and {r.k: r.parts for r in rows}["zero"] == 0


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(values.surrogate_key(["x", "y"]).alias("k")).distinct().count() == 2


def test_calendars(spark):
    days = calendar.dim_date(spark, "2026-12-14", "2018-01-01", 4000)
    last = days.agg(F.max("date_day"), F.count("*"), F.sum(F.col("is_fiscal_year_end").cast("int"))).first()
    assert tuple(last) == (date(2028, 12, 13), 4000, 10)
    shifted = calendar.dim_date(spark, "2024-06-30", "2024-01-01", 400, fiscal_start=2)
    by_day = {r.date_day: r for r in shifted.collect()}
    assert (by_day[date(2024, 1, 31)].fiscal_year, by_day[date(2024, 1, 31)].fiscal_quarter) == (2024, 4)
    assert by_day[date(2024, 1, 31)].is_fiscal_year_end and not by_day[date(2024, 2, 29)].is_fiscal_year_end
    assert (by_day[date(2024, 2, 1)].fiscal_year, by_day[date(2024, 2, 1)].fiscal_quarter) == (2025, 1)
    assert (by_day[date(2024, 4, 30)].fiscal_quarter, by_day[date(2024, 5, 1)].fiscal_quarter) == (1, 2)
    assert calendar.time_spine(spark, "2018-01-01", "2030-12-31").count() == 4747
    assert calendar.dim_date(spark, "2030-01-01").agg(F.max("date_day")).first()[0] == date(2032, 1, 1)
    assert calendar.date_range(spark, "2024-02-28", "2024-03-01").count() == 3
    assert calendar.date_range(spark, "2024-03-02", "2024-03-01").count() == 0
    monday = spark.sql("select date '2024-01-07' as d").select(period_start(F.col("d"), "week")).first()[0]
    assert monday == date(2024, 1, 1)


@pytest.mark.parametrize("ids, left, left_with_null", [
    (["a"], 1, 2), (["a", None], 1, 2), ([None], 2, 3), ([], 2, 3), (["a", None, *map(str, range(300))], 1, 2)])
def test_exclude_ids_has_one_rule_for_short_lists_long_lists_and_tables(spark, ids, left, left_with_null):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    table = spark.createDataFrame([(i,) for i in ids], "x string")
    for form in (ids, table):
        assert relational.exclude_ids(df, "id", form).count() == left
        assert relational.exclude_ids(df, "id", form, keep_null=True).count() == left_with_null


def test_latest_by_key_with_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", None, "z"), (None, 2, "n")], "k string, t int, v string")
    got = {r.k: (r.t, r.v) for r in latest_by_key(df, ["k"], ["t", "v"]).collect()}
    assert got == {"a": (1, "y"), "b": (None, "z"), None: (2, "n")}


def test_headcount_history(spark):
    df = spark.createDataFrame([("d", "1", date(2020, 5, 1), None), ("d", "2", date(2021, 1, 31), date(2021, 2, 28)),
                                ("d", "3", date(2021, 2, 1), date(2021, 2, 10)), ("d", "4", None, None)],
                               "department string, employee_id string, hire_date date, termination_date date")
    got = [(r.month.month, r.headcount, r.hires, r.terminations) for r in
           people.headcount_monthly(df, "2021-01-01", "2021-03-15").orderBy("month").collect()]
    assert got == [(1, 2, 1, 0), (2, 1, 1, 2), (3, 1, 0, 0)]


# --- sources and landing
def test_copy_into_aborts_on_bad_values_and_clashing_names(spark):
    df = spark.createDataFrame([("1", "x")], "ID string, Name string")
    assert landing.copy_into(df, "id int, name string, extra date").first().asDict() == {"id": 1, "name": "x", "extra": None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.copy_into(df, "name int").collect()
    with pytest.raises(ValueError):
        landing.copy_into(spark.createDataFrame([(1, 2)], "a int, b int").toDF("A", "a"), "a int")


def test_backfill_range_is_checked(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),)], "dt date")
    with pytest.raises(ValueError):
        landing.backfill_rows(df, "dt", "2021-02-01", "2021-01-01")
    with pytest.raises(ValueError):
        landing.backfill_rows(df, "dt", "2021-01-01", "2021-04-02")
    assert landing.backfill_rows(df, "dt", "2021-01-01", "2021-04-01").count() == 1


def test_landing_twice_replaces_the_day(spark):
    path = work_dir(spark, "landing")
    for n in (3, 2):
        landing.land_partition(spark.range(n), path, "2021-01-01", "2021-01-02 00:00:00")
    landing.land_partition(spark.range(4), path, "2021-01-02", "2021-01-02 00:00:00")
    counts = {r.dt.day: r["count"] for r in landing.complete_partitions(spark, path).groupBy("dt").count().collect()}
    assert counts == {1: 2, 2: 4}


def test_events_need_a_range_and_prune(spark):
    path = work_dir(spark, "events")
    schema = "event_id string, event_name string, account_id string, event_date date"
    rows = [(str(i), "e", "a", date(2021, 1, 1 + i % 9)) for i in range(90)]
    landing.write_events(spark.createDataFrame(rows, schema), path)
    with pytest.raises(ValueError):
        landing.read_events(spark, path, schema, "2021-01-01", None)
    df = landing.read_events(spark, path, schema, "2021-01-02", "2021-01-03")
    assert df.count() == 20
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_schema_drift_kinds(spark):
    a, b = spark.createDataFrame([], "x int, y string, z date"), spark.createDataFrame([], "x bigint, y string, w int")
    assert {(c, k, blocks) for c, k, _, _, blocks in landing.schema_drift(a.schema, b.schema)} == {
        ("x", "type_changed", True), ("z", "removed", True), ("w", "added", False)}


def test_registry(spark):
    assert len(registry.SOURCES) == 17
    assert registry.resolve_namespace("PROD", "raw") == "raw_prod"
    with pytest.raises(ValueError):
        registry.read_source(spark, "/nowhere", "crm.nothing")
    with pytest.raises(ValueError):
        registry.resolve_namespace("prod", "gold")


def test_work_dir_is_fresh_each_time(spark):
    assert work_dir(spark, "x") != work_dir(spark, "x")
