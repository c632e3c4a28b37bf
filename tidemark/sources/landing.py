"""Landing partitions, loads, merges, backfills and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.dates import day, instant
from tidemark.operators.product import events_between
from tidemark.operators.relational import latest_by_key


def _write_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace just the partitions that ``df`` holds."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows gathered by partition value for writing: adaptive execution splits a heavy value
    over several tasks and joins light ones, so files are few and of even size."""
    return df.hint("rebalance", F.col(column))


def stamp(df: DataFrame, extract_date: date | str, loaded_at: datetime | str) -> DataFrame:
    return df.withColumns({"_extract_date": day(extract_date), "_loaded_at": instant(loaded_at),
                           "dt": day(extract_date)})


def clear_partitions(spark: SparkSession, path: str, column: str, days: Sequence[date | str]) -> None:
    """Remove the partitions of ``days`` where they exist; a repeated call changes nothing."""
    jvm = spark._jvm
    for one in days:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={one}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def land_partition(df: DataFrame, path: str, extract_date: date | str, loaded_at: datetime | str) -> None:
    """Stamp the rows and write them as the ``dt`` partition of ``extract_date``.

    The manifest row is written after the data: it stands for the success marker, and a
    partition without one is not loadable.  Landing the same day again takes the marker away, replaces
    the data, also with none, and marks it again; readers never see half of it.
    """
    clear_partitions(df.sparkSession, f"{path}/manifest", "dt", [extract_date])
    if df.isEmpty():
        clear_partitions(df.sparkSession, f"{path}/data", "dt", [extract_date])
    _write_partitions(balanced(stamp(df, extract_date, loaded_at), "dt"), f"{path}/data", "dt")
    done = df.sparkSession.range(1).select(day(extract_date).alias("dt"), instant(loaded_at).alias("completed_at"))
    _write_partitions(done, f"{path}/manifest", "dt")


def _landed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/data")


def complete_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of partitions whose manifest row exists; the semi-join prunes the others."""
    done = spark.read.schema("dt date").parquet(f"{path}/manifest")
    return _landed(spark, path).join(done, "dt", "left_semi")


def landing_manifest(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Files and rows found per expected day (column ``dt``); empty days show zero."""
    files = (_landed(spark, path).groupBy("dt", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
             .groupBy("dt").agg(F.count("*").alias("files_found"), F.sum("n").alias("rows_found")))
    zero = F.lit(0).cast("bigint")
    return expected.join(files, "dt", "left").select(
        "dt", F.coalesce("files_found", zero).alias("files_found"), F.coalesce("rows_found", zero).alias("rows_found"),
        F.col("files_found").isNull().alias("is_empty"))


def copy_into(df: DataFrame, target: str) -> DataFrame:
    """Fit a batch to the target schema (DDL): columns by name in any case, missing ones null.

    Casts are ANSI casts (the session default): one bad value aborts the load.
    """
    wanted = T.StructType.fromDDL(target) if isinstance(target, str) else target
    given: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in given:
            raise ValueError(f"two columns differ only in case: {given[c.lower()]}, {c}")
        given[c.lower()] = c

    def fit(f: T.StructField) -> Column:
        if f.name.lower() in given:
            return F.col(f"`{given[f.name.lower()]}`").cast(f.dataType).alias(f.name)
        return F.lit(None).cast(f.dataType).alias(f.name)

    return df.select(*[fit(f) for f in wanted.fields])


def copy_once(batch: DataFrame, history: DataFrame, file_column: str = "file_path") -> DataFrame:
    """Rows of files that ``history`` (one row per loaded file) does not list."""
    return batch.join(history.select(file_column), file_column, "left_anti").select(*batch.columns)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    """Newest row per key of target and batch; at equal times the batch wins.

    A null in a key matches nothing: such rows of either side all stay.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)),
                                                           allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c not in (updated_at, "_new")]
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    newest = latest_by_key(both.filter(~keyless), keys, [updated_at, "_new", *rest])
    return newest.unionByName(both.filter(keyless)).drop("_new")


def _check_range(start: date | str, end: date | str, max_days: int) -> None:
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    if last < first:
        raise ValueError("the end lies before the start")
    if (last - first).days > max_days:
        raise ValueError(f"a backfill covers at most {max_days} days")


def backfill_rows(df: DataFrame, column: str, start: date | str, end: date | str, max_days: int = 90) -> DataFrame:
    _check_range(start, end, max_days)
    return df.filter(F.col(column).between(day(start), day(end)))


def backfill(df: DataFrame, column: str, path: str, start: date | str, end: date | str, max_days: int = 90) -> None:
    """Rewrite the days of the range and leave all other partitions as they are.

    Days of the range that get no rows end up empty.
    """
    rows = backfill_rows(df, column, start, end, max_days)
    # At most max_days + 1 values.
    filled = {r[0] for r in rows.select(column).distinct().collect()}
    _write_partitions(balanced(rows, column), path, column)
    first = date.fromisoformat(str(start))
    days = [first + timedelta(n) for n in range((date.fromisoformat(str(end)) - first).days + 1)]
    clear_partitions(df.sparkSession, path, column, [d for d in days if d not in filled])


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str | None, str | None, bool]]:
    """(column, change, expected type, actual type, blocks) per difference.

    A new column passes; a changed type or a missing column blocks the load.
    """
    old, new = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (expected, actual))
    found = [(c, "added", None, t, False) for c, t in new.items() if c not in old]
    found += [(c, "removed", t, None, True) for c, t in old.items() if c not in new]
    return found + [(c, "type_changed", t, new[c], True) for c, t in old.items() if c in new and new[c] != t]


def schema_drift_report(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The differences, with how many values they touch and how many of those cannot be cast.

    All columns are counted in one aggregate pass over the arrived rows.
    """
    found = schema_drift(expected.schema, actual.schema)
    if not found:
        return actual.sparkSession.createDataFrame(
            [], "column_name string, change string, expected_type string, actual_type string, blocks boolean, "
                "filled_values bigint, uncastable_values bigint")
    totals, rows = [F.count("*").alias("_n")], []
    none = F.lit(0).cast("bigint")
    for c, change, old, new, blocks in found:
        filled = uncastable = none
        if new is not None:
            totals.append(F.count(F.col(f"`{c}`")).alias(f"filled:{c}"))
            filled = F.col(f"`filled:{c}`")
        if change == "type_changed":
            lost = F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(old).isNull()
            totals.append(F.count(F.when(lost, 1)).alias(f"uncastable:{c}"))
            uncastable = F.col(f"`uncastable:{c}`")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(change).alias("change"),
            F.lit(old).cast("string").alias("expected_type"), F.lit(new).cast("string").alias("actual_type"),
            F.lit(blocks).alias("blocks"), filled.alias("filled_values"), uncastable.alias("uncastable_values")))
    return actual.agg(*totals).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that cast cleanly to ``rules`` (column to type), and the others with reasons."""
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in rules.items()}
    reasons = F.array_compact(F.array(*[F.when(b, F.lit(f"{c} is not {rules[c]}")) for c, b in bad.items()]))
    judged = df.withColumn("_reasons", reasons)
    good = judged.filter(F.size("_reasons") == 0).select(
        *[F.col(c).try_cast(rules[c]).alias(c) if c in rules else F.col(c) for c in df.columns])
    errors = judged.filter(F.size("_reasons") > 0).withColumnRenamed("_reasons", "reasons")
    return good, errors


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_partition(df: DataFrame, column: str, exported_day: date | str, path: str) -> DataFrame:
    """Write one day as its ``dt`` partition, empty if it has no rows, and return the exported rows."""
    rows = df.filter(F.col(column) == day(exported_day)).withColumn("dt", F.col(column))
    if rows.isEmpty():
        clear_partitions(df.sparkSession, path, "dt", [exported_day])
    _write_partitions(balanced(rows, "dt"), path, "dt")
    return rows


def write_events(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Events by day, clustered by name and account inside.

    Range partitioning on (day, name, account, event) cuts a heavy day, name or account into
    several files, which hashing on the day would not; sorted files let row groups be skipped.
    """
    order = ["event_date", "event_name", "account_id", "event_id"]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    _write_partitions(ranged.sortWithinPartitions(*order), path, "event_date")


def read_events(spark: SparkSession, path: str, schema: str, start: date | str, end: date | str) -> DataFrame:
    """Stored events of a mandatory range of days; other partitions are not listed or read."""
    return events_between(spark.read.schema(schema).parquet(path), start, end)
