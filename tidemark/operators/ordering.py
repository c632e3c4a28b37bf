"""Ordered scans (previous, next, carried-forward, running total) that survive heavy keys.

A plain window puts all rows of a key into one task.  Here the few heavy keys (see
``skew.hot_keys``) are cut into time buckets: their window runs per (key, bucket), and one
summary row per (key, bucket) hands the state over to the next bucket.  All other keys stay
in one bucket and cost a plain window, one shuffle.  The summaries are partial aggregates
over the heavy keys' rows only, which a broadcast semi-join picks out at the scan; they are
added with a union, not a join.

Rows without a key have no neighbours and carry nothing; they are scattered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import micros
from tidemark.operators.skew import hot_keys

_BUCKET, _SIDE, _STATE, _HOT = "_bucket", "_side", "_state", "_hot"
_SCATTER = 4096


def _slot(time: str, width: str) -> Column:
    return micros(F.date_trunc(width, F.col(time)))


def _bucketed(df: DataFrame, key: str, order: Sequence[str], width: str, hot: DataFrame) -> DataFrame:
    flagged = df.join(F.broadcast(hot.withColumn(_HOT, F.lit(True))), key, "left")
    bucket = (F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*order), F.lit(_SCATTER)))
              .when(F.col(_HOT), _slot(order[0], width)).otherwise(F.lit(0).cast("bigint")))
    return flagged.withColumn(_BUCKET, bucket).drop(_HOT)


def _heavy(df: DataFrame, key: str, order: Sequence[str], width: str, hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot), key, "left_semi").withColumn(_BUCKET, _slot(order[0], width))


def _with_carried(rows: DataFrame, carried: DataFrame, side: int) -> DataFrame:
    carried = carried.filter(F.col(_STATE).isNotNull()).withColumn(_SIDE, F.lit(side))
    return rows.withColumn(_SIDE, F.lit(0)).unionByName(carried, allowMissingColumns=True)


def _neighbour(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], width: str,
               hot: DataFrame | None, prefix: str, forward: bool) -> DataFrame:
    order = list(order)
    hot = hot_keys(df, key) if hot is None else hot
    # A marker makes "no neighbour" and "neighbour full of nulls" two different things.
    state = F.struct(F.lit(True).alias("present"), *values)
    edge = F.min_by if forward else F.max_by
    shift = F.lead if forward else F.lag
    carried = (_heavy(df, key, order, width, hot).groupBy(key, _BUCKET)
               .agg(edge(state, F.struct(*order)).alias(_STATE))
               .withColumn(_STATE, shift(_STATE).over(Window.partitionBy(key).orderBy(_BUCKET))))
    rows = _bucketed(df, key, order, width, hot).withColumn(_STATE, state)
    inside = Window.partitionBy(key, _BUCKET).orderBy(_SIDE, *order)
    found = F.when(F.col(key).isNotNull(), shift(_STATE).over(inside))
    return (
        _with_carried(rows, carried, 1 if forward else -1)
        .withColumn("_found", found).filter(F.col(_SIDE) == 0)
        .select(*df.columns, F.coalesce(F.col("_found.present"), F.lit(False)).alias(f"has_{prefix}"),
                *[F.col(f"_found.`{v}`").alias(f"{prefix}_{v}") for v in values])
    )


def with_previous(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], width: str = "hour",
                  hot: DataFrame | None = None) -> DataFrame:
    """Add ``has_previous`` and ``previous_<v>``: the values of the row before, per key.

    ``order[0]`` is a date or zone-free timestamp; later entries break ties.  ``hot`` saves
    the search for heavy keys where the caller has done it on cheaper input.
    """
    return _neighbour(df, key, order, values, width, hot, "previous", forward=False)


def with_next(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], width: str = "hour",
              hot: DataFrame | None = None) -> DataFrame:
    """Add ``has_next`` and ``next_<v>``: the values of the row after, per key."""
    return _neighbour(df, key, order, values, width, hot, "next", forward=True)


def _running(df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, width: str,
             hot: DataFrame | None, per_bucket, over_rows) -> DataFrame:
    order = list(order)
    hot = hot_keys(df, key) if hot is None else hot
    valued = df.withColumn(_STATE, value)
    earlier = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (_heavy(valued, key, order, width, hot).groupBy(key, _BUCKET).agg(per_bucket(order).alias(_STATE))
               .withColumn(_STATE, over_rows(_STATE).over(earlier)))
    inside = (Window.partitionBy(key, _BUCKET).orderBy(_SIDE, *order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = _bucketed(valued, key, order, width, hot)
    return (_with_carried(rows, carried, -1)
            .withColumn(name, F.when(F.col(key).isNotNull(), over_rows(_STATE).over(inside)))
            .filter(F.col(_SIDE) == 0).select(*df.columns, name))


def carry_forward(df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, width: str = "hour",
                  hot: DataFrame | None = None) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to and including each row, per key."""
    def last_known(order):
        return F.max_by(_STATE, F.when(F.col(_STATE).isNotNull(), F.struct(*order)))

    return _running(df, key, order, value, name, width, hot, last_known, lambda c: F.last(c, ignorenulls=True))


def running_total(df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, width: str = "hour",
                  hot: DataFrame | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` from the key's first row to each row."""
    return _running(df, key, order, value, name, width, hot, lambda order: F.sum(_STATE), F.sum)
