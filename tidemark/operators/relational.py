"""Small building blocks shared by all domains: projections, filters, latest rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import day

# Lists up to this length become an IN predicate that reaches the scan.
INLINE_IDS = 200


def rename_cast(df: DataFrame, spec: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Project by ``{new: old}`` or ``{new: (old, type)}``; nothing else is read."""
    return df.select(*[
        F.col(old).alias(new) if isinstance(old, str) else F.col(old[0]).cast(old[1]).alias(new)
        for new, old in spec.items()
    ])


def drop_soft_deleted(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def exclude_ids(df: DataFrame, column: str, ids: Sequence[str] | DataFrame, keep_null: bool = False) -> DataFrame:
    """Rows whose ``column`` is not among ``ids``; rows without an id go too, unless ``keep_null``.

    Nulls among ``ids`` exclude nothing, and an empty list or table excludes nothing but rows without
    an id.  A short list is a pushed-down predicate, anything longer an anti-join whose strategy the
    optimizer picks from the size of the list; the rows are the same.
    """
    given = F.col(column)
    kept = df if keep_null else df.filter(given.isNotNull())
    if not isinstance(ids, DataFrame):
        ids = [i for i in ids if i is not None]
        if not ids:
            return kept
        if len(ids) <= INLINE_IDS:
            return kept.filter(given.isNull() | ~given.isin(ids))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"`{column}` string")
    listed = ids.select(F.col(ids.columns[0]).alias(column))
    return kept.join(listed, column, "left_anti").select(*df.columns)


def status_in(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def lookback(df: DataFrame, date_column: str, days: int, as_of: date | str) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``.

    The predicate is on the stored date column and a literal, so partitions prune and
    row groups are skipped.
    """
    return df.filter((F.col(date_column) >= F.date_sub(day(as_of), days))
                     & (F.col(date_column) <= day(as_of)))


def not_in_events(df: DataFrame, name: str = "event_name", account: str = "account_id",
                  ignored: Sequence[str] = ("session_start", "first_open")) -> DataFrame:
    return df.filter(F.col(account).isNotNull() & ~F.col(name).isin(*ignored))


def incremental_since(df: DataFrame, column: str, since: date | str) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(str(since)).cast(df.schema[column].dataType))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order`` (ascending; the last entries break ties).

    ``max_by`` combines on the map side, so a key that owns a third of the rows sends one
    row per task instead of sorting in a single one.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    picked = df.groupBy(*keys).agg(newest.alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def distinct_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, kind, value, n): each distinct value of each column per key, with its row count.

    The base of several distinct counts at once.  Values are unpivoted and grouped with
    map-side combine; the shuffle is on the values too, so a heavy key is spread by them.
    """
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(*keys, F.explode(kinds).alias("_v")).select(*keys, "_v.kind", "_v.value")
            .groupBy(*keys, "kind", "value").agg(F.count("*").alias("n")))


def count_of(kind: str) -> Column:
    """Number of distinct non-null values of ``kind`` among ``distinct_values`` rows."""
    return F.count(F.when(F.col("kind") == kind, F.col("value")))


def latest_value(df: DataFrame, value: str, order: str) -> DataFrame:
    """One row: the value at the greatest ``order``."""
    return df.agg(F.max(order).alias(order), F.max_by(value, order).alias(value))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; planned as TakeOrderedAndProject, without a full sort."""
    return df.orderBy(*order).limit(k)


def growth_rate(series: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Change against the previous period.  ``series`` is already one row per period."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(period)
    before = F.lag(value).over(w).cast("double")
    return series.withColumn("growth", F.try_divide(F.col(value).cast("double") - before, before))
