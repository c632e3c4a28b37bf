"""Structured Streaming forms of the event operators.

Functions named ``stream_`` map a streaming DataFrame to another.  ``run_available`` drives one to the
end of its input in append mode, ``run_upserts`` in update mode, where windows that are still open count too.  Times are zoned timestamps, because watermarks
refuse zone-free ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.dates import instant, micros
from tidemark.operators.relational import count_of, distinct_values, latest_by_key


def stream_events(spark: SparkSession, path: str, schema: str, files: str = "*.parquet",
                  max_files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder as a stream; the checkpoint of the query remembers what was read."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", files)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def run_available(df: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """Process all available input into parquet below ``out`` and read the result back."""
    query = (df.writeStream.outputMode(mode).format("parquet").option("path", f"{out}/data")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/data")


def timed(events: DataFrame, ts: str = "event_timestamp", delay: str = "1 hour") -> DataFrame:
    """Add the event time ``at`` with its watermark: the zone-free time read as UTC, so that
    days begin at midnight in any session zone."""
    return events.withColumn("at", F.timestamp_micros(micros(F.col(ts)))).withWatermark("at", delay)


def _wall(at: Column) -> Column:
    """Back to the zone-free time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), instant("1970-01-01"))


def stream_dedupe(events: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Drop repeats of an at-least-once source; state lives as long as the watermark delay."""
    return events.dropDuplicatesWithinWatermark(list(keys))


# Batches that are kept as they came before they are put together.
COMPACT_EVERY = 20


def _numbered(spark: SparkSession, path: str, prefix: str, whole: bool = False) -> list[int]:
    """The numbers of the folders ``prefix=number`` below ``path``; with ``whole`` only those written to the end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith(f"{prefix}=")]
    if whole:
        found = [f for f in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().split("=", 1)[1]) for f in found)


def _logged(spark: SparkSession, schema: T.StructType, out: str) -> DataFrame:
    """The rows that decide, with their batch: the last compaction and the batches after it."""
    held = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    compactions = _numbered(spark, f"{out}/compacted", "upto", whole=True)
    batches = spark.read.schema(held).parquet(f"{out}/data")
    if not compactions:
        return batches
    last = compactions[-1]
    return batches.filter(F.col("batch") > last).unionByName(spark.read.schema(held).parquet(f"{out}/compacted/upto={last}"))


def compact_upserts(spark: SparkSession, schema: T.StructType, out: str, keys: Sequence[str], order: Sequence[str], upto: int) -> None:
    """Put the batches up to ``upto`` and the last compaction together as one row per key.

    A compaction counts once it is written to the end, so a broken one is written again.  Batches and compactions
    that the one before had replaced are removed; those that a reader of now may still hold stay until the next.
    """
    before = _numbered(spark, f"{out}/compacted", "upto", whole=True)
    if before and before[-1] >= upto:
        return
    rows = latest_by_key(_logged(spark, schema, out).filter(F.col("batch") <= upto), keys, [*order, "batch"])
    rows.write.mode("overwrite").parquet(f"{out}/compacted/upto={upto}")
    if not before:
        return
    old = [f"{out}/compacted/upto={n}" for n in before[:-1]]
    old += [f"{out}/data/batch={n}" for n in _numbered(spark, f"{out}/data", "batch") if 0 <= n <= before[-1]]
    for path in old:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_upserts(spark: SparkSession, schema: T.StructType, out: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row of each key that ``run_upserts`` has left below ``out``; reads the last compaction and later batches only."""
    return latest_by_key(_logged(spark, schema, out), keys, [*order, "batch"]).drop("batch")


def run_upserts(df: DataFrame, out: str, keys: Sequence[str], order: Sequence[str] = (), mode: str = "update",
                compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Process all available input and return the last row of each key, open windows included.

    Each micro-batch writes the rows it changed as its own ``batch`` partition below ``out``; a repeated
    batch replaces it.  A batch begins when those before it are final, so every ``compact_every`` batches it first puts
    them together; what is kept and read stays within the keys and that many batches.  Reading takes the newest row per key
    (by ``order``, then batch) with a map-side combine.
    """
    schema, spark, data = df.schema, df.sparkSession, f"{out}/data"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{data}/batch=-1")

    def keep(rows: DataFrame, batch: int) -> None:
        done = _numbered(spark, f"{out}/compacted", "upto", whole=True)
        if batch - 1 - (done[-1] if done else -1) >= compact_every:
            compact_upserts(spark, schema, out, keys, order, batch - 1)
        newest = latest_by_key(rows, keys, order) if order else rows
        newest.write.mode("overwrite").parquet(f"{data}/batch={batch}")

    query = (df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return read_upserts(spark, schema, out, keys, order)


ACTIVITY_KEYS = ("activity_date", "account_id", "user_id", "session_id", "event_name")
SLOT_KEYS = ("user_id", "slot")
WINDOW_KEYS = ("window_start", "event_name")


def stream_activity(events: DataFrame, ignored: Sequence[str] = ("session_start", "first_open")) -> DataFrame:
    """Running event counts by day, account, user, session and event name, for update mode.

    The keys spread a dominant account over its users and sessions; ``daily_engagement`` counts them exactly.
    """
    active = events.filter(F.col("account_id").isNotNull() & ~F.col("event_name").isin(*ignored))
    return active.groupBy(F.window("at", "1 day").alias("day"), *ACTIVITY_KEYS[1:]).agg(F.count("*").alias("events")).select(
        _wall(F.col("day.start")).cast("date").alias("activity_date"), *ACTIVITY_KEYS[1:], "events")


def daily_engagement(activity: DataFrame) -> DataFrame:
    """Day x account from the rows of ``stream_activity``: exact users, events, sessions and features."""
    kinds = {"dau": "user_id", "sessions": "session_id", "features": "event_name"}
    values = distinct_values(activity, ["activity_date", "account_id"], list(kinds.values()))
    counted = values.groupBy("activity_date", "account_id").agg(*[count_of(c).alias(n) for n, c in kinds.items()])
    events = activity.groupBy("activity_date", "account_id").agg(F.sum("events").alias("event_count"))
    return counted.join(events, ["activity_date", "account_id"])


def stream_engagement_approx(events: DataFrame, rsd: float = 0.02,
                             ignored: Sequence[str] = ("session_start", "first_open")) -> DataFrame:
    """Day x account in one store, with sketches of fixed size in place of the user sets, for update mode."""
    active = events.filter(F.col("account_id").isNotNull() & ~F.col("event_name").isin(*ignored))
    return active.groupBy(F.window("at", "1 day").alias("day"), "account_id").agg(
        F.approx_count_distinct("user_id", rsd).alias("dau"), F.count("*").alias("event_count"),
        F.approx_count_distinct("session_id", rsd).alias("sessions"),
    ).select(_wall(F.col("day.start")).cast("date").alias("activity_date"), "account_id", "dau", "event_count", "sessions")


def stream_slots(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """First and last time and count of events per user and slot of one gap, for update mode.

    Slots spread a very active user over tasks; ``sessions`` joins them.
    """
    return (events.filter(F.col("user_id").isNotNull()).groupBy(F.window("at", gap).alias("w"), "user_id")
            .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("events"))
            .select("user_id", _wall(F.col("w.start")).alias("slot"), _wall(F.col("first")).alias("first"),
                    _wall(F.col("last")).alias("last"), "events"))


def sessions(slots: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user, the open one included, from slots: two events exactly one gap apart share a session.

    A window holds one row per slot of a user, not one per event.
    """
    order = Window.partitionBy("user_id").orderBy("slot")
    fresh = F.coalesce(F.col("first") - F.lag("last").over(order) > F.expr(f"interval {gap}"), F.lit(True))
    numbered = slots.withColumn("fresh", fresh.cast("int")).withColumn("number", F.sum("fresh").over(order))
    return numbered.groupBy("user_id", "number").agg(
        F.min("first").alias("session_start"), F.max("last").alias("session_end"), F.sum("events").alias("events")).drop("number")


def stream_windows(events: DataFrame, window: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """Running event counts per sliding window and event name, for update mode."""
    return (events.groupBy(F.window("at", window, slide).alias("w"), "event_name").agg(F.count("*").alias("events"))
            .select(_wall(F.col("w.start")).alias("window_start"), "event_name", "events"))


def anomalies(windows: DataFrame, baseline: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Windows, open ones included, whose event count is more than ``threshold`` deviations off its baseline.

    ``baseline`` is static: event_name, mean_events, sd_events.
    """
    z = (F.col("events") - F.col("mean_events")) / F.nullif(F.col("sd_events"), F.lit(0.0))
    return (windows.join(baseline, "event_name").withColumn("z_score", z).filter(F.abs("z_score") > threshold)
            .select("window_start", "event_name", "events", "z_score"))


def hourly_baseline(events: DataFrame) -> DataFrame:
    """Mean and deviation of hourly counts per event name, from stored events.

    The events shrink to one row per name and hour with map-side combine first.
    """
    hourly = events.groupBy("event_name", F.date_trunc("hour", "event_timestamp").alias("h")).agg(
        F.count("*").alias("n"))
    count, total, squares = F.count("n"), F.sum("n"), F.sum(F.col("n") * F.col("n"))
    sums = hourly.groupBy("event_name").agg(count.alias("c"), total.alias("s"), squares.alias("q"))
    # Integer sums make the deviation independent of the order of the rows.
    variance = (F.col("c") * F.col("q") - F.col("s") * F.col("s")).cast("double") / F.nullif(
        (F.col("c") * (F.col("c") - 1)).cast("double"), F.lit(0.0))
    return sums.select("event_name", (F.col("s").cast("double") / F.col("c")).alias("mean_events"),
                       F.sqrt(variance).alias("sd_events"))


def late_events(events: DataFrame, arrival: str, ts: str, delay: str, batch: str = "hour") -> DataFrame:
    """Events that lay behind the watermark when they arrived, for batches of one ``batch``.

    The watermark of a batch is the newest event time of all earlier batches minus ``delay``.
    Event times are reduced to one maximum per batch; the running maximum sees batches only.
    """
    numbered = events.withColumn("_batch", F.date_trunc(batch, F.col(arrival)).cast("timestamp_ntz"))
    earlier = Window.orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1)
    marks = numbered.groupBy("_batch").agg(F.max(ts).alias("_max")).select(
        "_batch", (F.max("_max").over(earlier) - F.expr(f"interval {delay}")).alias("watermark"))
    return numbered.join(marks, "_batch").filter(F.col(ts) < F.col("watermark")).drop("_batch")
