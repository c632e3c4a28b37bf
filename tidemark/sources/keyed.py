"""Tables stored by key bucket, so that a merge reads and rewrites only the buckets its batch touches.

A bucket is a hash of the key modulo the number of buckets that the table was created with; it is a partition of the stored
rows.  A batch names its buckets (at most that many numbers), the scan of the target is cut to them by a
partition filter, and a dynamic overwrite replaces just them.  All merges can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.history import VALID, scd2_merge, start_history
from tidemark.session import checkpointed
from tidemark.sources.landing import balanced, copy_into, merge_upsert

BUCKET = "_bucket"
_LAYOUT = "keys array<string>, buckets int, columns string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _create(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> None:
    """Set down how the table is cut; the last thing that a creation writes."""
    layout = spark.createDataFrame([(list(keys), buckets, schema.json())], _LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def layout_of(spark: SparkSession, path: str) -> tuple[list[str], int, T.StructType]:
    """Keys, number of buckets and columns of a table."""
    import json

    row = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first()
    return list(row["keys"]), row["buckets"], T.StructType.fromJson(json.loads(row["columns"]))


def _stored(spark: SparkSession, folder: str, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
    return rows if buckets is None else rows.filter(F.col(BUCKET).isin(*buckets))


def _replace(df: DataFrame, folder: str, column: str = BUCKET) -> None:
    (balanced(df, column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(folder))


def _touched(batch: DataFrame) -> list[int]:
    """The buckets of a batch: no more numbers than the table has buckets."""
    return sorted(r[0] for r in batch.select(BUCKET).distinct().collect())


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """Store ``df``, one row per key, by bucket of the key."""
    _replace(df.withColumn(BUCKET, bucket_of(keys, buckets)), f"{path}/rows")
    _create(df.sparkSession, path, df.schema, keys, buckets)


def read_keyed(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a table, or of some of its buckets."""
    return _stored(spark, f"{path}/rows", layout_of(spark, path)[2], buckets).drop(BUCKET)


def merge_into(batch: DataFrame, path: str, updated_at: str) -> list[int]:
    """Merge a batch into a stored table by ``merge_upsert`` and return the buckets that were rewritten.

    The newest row of each key stands, the batch's at equal times.  Columns go by name in any case and are cast to the
    table's; a null in a key matches nothing, so such rows are added, and added again if the batch is repeated.  A batch
    without rows touches nothing.
    """
    spark = batch.sparkSession
    keys, buckets, schema = layout_of(spark, path)
    placed = checkpointed(copy_into(batch, schema).withColumn(BUCKET, bucket_of(keys, buckets)), "batch")
    touched = _touched(placed)
    if touched:
        # The merged rows are set down before the old ones go, so a lost task never reads a half replaced bucket.
        old = _stored(spark, f"{path}/rows", schema, touched)
        _replace(checkpointed(merge_upsert(old, placed, keys, updated_at), "merged"), f"{path}/rows")
    return touched


def create_history(batch: DataFrame, path: str, key: str, updated_at: str, buckets: int = 256) -> None:
    """Store the first snapshot of a type-2 history: open versions by bucket of the key, no closed ones yet."""
    opened = start_history(batch, key, updated_at)
    spark = batch.sparkSession
    _replace(opened.withColumn(BUCKET, bucket_of([key], buckets)), f"{path}/open")
    _create(spark, path, opened.schema, [key], buckets)


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The merges that were set down as a whole, oldest first; one short name per merge."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/done")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return sorted(r["run"] for r in spark.read.schema("run string").parquet(f"{path}/done").collect())


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, closed and open."""
    _, _, schema = layout_of(spark, path)
    names, runs = [f.name for f in schema.fields], _runs(spark, path)
    current = _stored(spark, f"{path}/open", schema).select(*names)
    if not runs:
        return current
    closed = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).parquet(f"{path}/closed")
    return current.unionByName(closed.filter(F.col("run").isin(*runs)).select(*names))


def merge_history(batch: DataFrame, path: str, updated_at: str, as_of: date | datetime | str,
                  hard_deletes: bool = False) -> list[int]:
    """Merge one batch, named by ``as_of``, into a stored history by ``scd2_merge`` and return the buckets rewritten.

    Open versions of touched buckets are read and rewritten, closed ones only added to.  With ``hard_deletes`` the batch is a
    whole snapshot and every bucket counts as touched.  What a merge closes and opens is written first and
    marked done; only then open buckets are replaced.  A merge that broke off goes on from there when it is
    repeated, a repeated one changes nothing, and one older than the last is refused.
    """
    spark = batch.sparkSession
    (key,), buckets, schema = layout_of(spark, path)
    names, run, runs = [f.name for f in schema.fields], f"run {as_of}", _runs(spark, path)
    if runs and run < runs[-1]:
        raise ValueError(f"merges go forward in time: {run} comes before {runs[-1]}")
    pending = f"{path}/pending/{str(as_of).replace(' ', '_').replace(':', '.')}"
    if run not in runs:
        payload = T.StructType([f for f in schema.fields if f.name not in VALID])
        placed = checkpointed(copy_into(batch, payload).filter(F.col(key).isNotNull()).withColumn(BUCKET, bucket_of([key], buckets)),
                              "batch")
        touched = list(range(buckets)) if hard_deletes else _touched(placed)
        if not touched:
            return []
        current = _stored(spark, f"{path}/open", schema, touched).drop(BUCKET)
        merged = checkpointed(scd2_merge(current, placed.drop(BUCKET), key, updated_at, as_of, hard_deletes), "merged")
        gone = merged.filter(F.col("valid_to").isNotNull()).select(*names).withColumn("run", F.lit(run))
        _replace(gone, f"{path}/closed", "run")
        still = merged.filter(F.col("valid_to").isNull()).select(*names).withColumn(BUCKET, bucket_of([key], buckets))
        # A bucket that keeps no open version is named by its number alone.
        listed = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        still.unionByName(listed.join(still.select(BUCKET).distinct(), BUCKET, "left_anti"), allowMissingColumns=True).write.mode(
            "overwrite").parquet(pending)
        spark.createDataFrame([(run,)], "run string").write.mode("append").parquet(f"{path}/done")
    still = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(pending)
    touched = _touched(still)
    rows = still.filter(F.col(key).isNotNull())
    emptied = sorted(set(touched) - set(_touched(rows)))
    _replace(rows, f"{path}/open")
    for b in emptied:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/open/{BUCKET}={b}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
