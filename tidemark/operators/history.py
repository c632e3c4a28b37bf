"""Slowly changing history (type 2): build, merge, look up, unfold."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidemark.functions.dates import day, instant
from tidemark.operators.ordering import carry_forward, with_next, with_previous
from tidemark.operators.relational import latest_by_key
from tidemark.operators.skew import hot_keys, spread_to_unfold

VALID = ("valid_from", "valid_to", "is_current")
# Days that are unfolded at a time in Python, and places of groups and days that are added up at a time.
_UNFOLDED, _CELLS = 1 << 18, 1 << 20


def scd2_from_history(versions: DataFrame, key: str, ts: str, columns: Sequence[str],
                      tiebreak: Sequence[str] = (), width: str = "hour") -> DataFrame:
    """All versions to validity intervals; consecutive equal versions become one.

    Of several versions at one instant the last by ``tiebreak`` and ``columns`` stands.  Rows
    without a key are no versions of anything and are left out.
    """
    columns = list(columns)
    order = [ts, *tiebreak, *[c for c in columns if c not in tiebreak]]
    slim = (versions.filter(F.col(key).isNotNull()).select(key, *dict.fromkeys(order))
            .withColumn(ts, F.col(ts).cast("timestamp_ntz")))
    hot = hot_keys(slim, key)
    standing = latest_by_key(slim, [key, ts], order[1:]).select(key, ts, *columns)
    seen = with_previous(standing, key, [ts], columns, width, hot)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"previous_{c}"))
    changed = seen.filter(~F.col("has_previous") | ~same).select(key, ts, *columns)
    ended = with_next(changed, key, [ts], [ts], width, hot)
    return ended.select(key, *columns, F.col(ts).alias("valid_from"), F.col(f"next_{ts}").alias("valid_to"),
                        (~F.col("has_next")).alias("is_current"))


def start_history(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The first snapshot: every key of the batch opens one version."""
    newest = _newest(batch, key, updated_at)
    return newest.withColumns({"valid_from": F.col(updated_at).cast("timestamp_ntz"),
                               "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)})


def _newest(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    rest = [c for c in batch.columns if c not in (key, updated_at)]
    return latest_by_key(batch.filter(F.col(key).isNotNull()), [key], [updated_at, *rest])


def scd2_merge(history: DataFrame, batch: DataFrame, key: str, updated_at: str, as_of: date | str,
               hard_deletes: bool = True) -> DataFrame:
    """Merge one batch into a history by the timestamp strategy.

    A newer ``updated_at`` closes the open version and opens another; an open key that the
    batch lacks closes at ``as_of``; a new or returning key opens.  Running the same batch
    again changes nothing.  Open versions and batch are unique per key, so the full join
    cannot fan out; closed versions never enter it.
    """
    payload = [c for c in batch.columns if c != key]
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull()).select(
        key, F.struct(*payload, "valid_from").alias("old"))
    arrived = _newest(batch, key, updated_at).select(key, F.struct(*payload).alias("new"))
    both = current.join(arrived, key, "full")
    at = F.col(f"new.`{updated_at}`").cast("timestamp_ntz")
    replaced = F.col("old").isNotNull() & F.col("new").isNotNull() & (at > F.col("old.valid_from"))
    vanished = F.col("old").isNotNull() & F.col("new").isNull() & F.lit(hard_deletes)
    end = F.when(replaced, at).when(vanished, instant(as_of))

    def version(side: str, start, finish):
        fields = [F.col(f"{side}.`{c}`").alias(c) for c in payload]
        return F.struct(*fields, start.alias("valid_from"), finish.alias("valid_to"),
                        finish.isNull().alias("is_current"))

    kept = F.when(F.col("old").isNotNull(), version("old", F.col("old.valid_from"), end))
    opened = F.when(F.col("new").isNotNull() & (F.col("old").isNull() | replaced),
                    version("new", at, F.lit(None).cast("timestamp_ntz")))
    merged = (both.select(key, F.explode(F.array_compact(F.array(kept, opened))).alias("v"))
              .select(key, "v.*"))
    return closed.select(*merged.columns).unionByName(merged)


def as_of_lookup(facts: DataFrame, history: DataFrame, key: str, at: str, columns: Sequence[str],
                 width: str = "hour", hot: DataFrame | None = None) -> DataFrame:
    """Each fact with the version valid at its time, half-open ``[valid_from, valid_to)``.

    Facts and versions are laid on one time line per key and the last version start is
    carried forward.  No pair of fact and version is built, so a key with many facts and
    many versions costs their sum and not their product.  ``hot`` lists heavy keys of either
    side; without it they are looked for in both.
    """
    columns = list(columns)
    version = F.struct(*columns, "valid_from", "valid_to")
    starts = history.select(F.col(key), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
                            version.alias("_version"))
    asked = facts.select(F.col(key), F.col(at).cast("timestamp_ntz").alias("_at"), F.lit(1).alias("_kind"),
                         F.struct(*facts.columns).alias("_fact"))
    line = starts.unionByName(asked, allowMissingColumns=True)
    found = carry_forward(line, key, ["_at", "_kind"], F.col("_version"), "_valid", width, hot)
    live = F.col("_valid.valid_to").isNull() | (F.col("_at") < F.col("_valid.valid_to"))
    return found.filter(F.col("_kind") == 1).select(
        *[F.col(f"_fact.`{c}`").alias(c) for c in facts.columns],
        *[F.when(live, F.col(f"_valid.`{c}`")).alias(f"valid_{c}") for c in columns],
        F.when(live, F.col("_valid.valid_from")).alias("valid_from"))


def daily_snapshot_append(history: DataFrame, start: date | str, end: date | str,
                          open_when=None) -> DataFrame:
    """One row per version and day on which it was valid at midnight.

    ``open_when`` filters versions first, e.g. on an open stage; the result is as large as
    the snapshot table it stands for, and nothing before it is.
    """
    return _by_day(_open_spans(history, start, end, open_when))


def append_daily_snapshots(history: DataFrame, path: str, start: date | str, end: date | str, open_when=None) -> None:
    """Add the days after the last stored one, up to ``end``, to the snapshot table below ``path``.

    The rows of ``daily_snapshot_append`` are stored as runs of days, one row per version with its first and its last
    day, in a folder named after the first day that is added; ``read_daily_snapshots`` gives one row per version and
    day again.  So many days at once take the room of the versions, not of versions times days.  Days that are
    stored stay as they are, but for the last one: it is added again, as a run may have broken off in it, and a folder
    takes over from its first day on.  A repeated run changes nothing.
    """
    spark = history.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    begin = str(start)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        last = spark.read.schema("last_day date").parquet(path).agg(F.max("last_day")).first()[0]
        begin = max(begin, str(last)) if last else begin
    spans = _open_spans(history, begin, end, open_when).withColumnsRenamed({"_first": "first_day", "_last": "last_day"})
    first = spans.agg(F.min("first_day")).first()[0]
    (spans.withColumn("from_day", F.lit(first).cast("date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("from_day").parquet(path))


def read_daily_snapshots(spark: SparkSession, path: str, schema: str,
                         once: Mapping[str, Column] | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """The table that ``append_daily_snapshots`` keeps below ``path``: the columns of ``schema`` and ``snapshot_date``, one
    row per version and day.

    ``once`` adds columns that are worked out once per stored run of days, not again on each of its days.  With ``by``
    these are whole numbers, and the rows are added up batch by batch as they are unfolded, which spares a lookup of the
    group for each of them: of every batch there is one row per ``by`` and day, with the count ``versions`` and the sums
    of the columns in ``once``, still to be added up over the batches.
    """
    stored = spark.read.schema(f"{schema}, first_day date, last_day date, from_day date").parquet(path)
    # One row per folder, so as many as there were runs.
    until = F.date_sub(F.lead("from_day").over(Window.orderBy("from_day")), 1)
    folders = stored.select("from_day").distinct().select("from_day", until.alias("_until"))
    spans = stored.join(F.broadcast(folders), "from_day").withColumns(
        {"_first": F.col("first_day"), "_last": F.least("last_day", "_until")}).filter(F.col("_last") >= F.col("_first"))
    spans = spans.drop("first_day", "last_day", "from_day", "_until").withColumns(dict(once or {}))
    if by is None:
        return _by_day(spread_to_unfold(spans))
    narrow = spans.select(*by, *[F.col(name).cast("bigint").alias(name) for name in once or {}], "_first", "_last")
    schema = StructType([*[narrow.schema[c] for c in by], StructField("snapshot_date", DateType(), False),
                         StructField("versions", LongType(), False), *[StructField(name, LongType()) for name in once or {}]])
    return spread_to_unfold(narrow).mapInArrow(_added_by_day(list(by), list(once or {})), schema)


def _open_spans(history: DataFrame, start: date | str, end: date | str, open_when) -> DataFrame:
    rows = history if open_when is None else history.filter(open_when)
    return _valid_days(rows, start, end).drop(*VALID)


def _by_day(spans: DataFrame) -> DataFrame:
    return spans.withColumn("snapshot_date", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def _added_by_day(by: list[str], measures: list[str]):
    """Unfolds runs of days in Python and adds the days up, one row per ``by`` and day for each part of a batch."""
    unfolded, most_cells = _UNFOLDED, _CELLS

    def groups(batch):
        codes = np.zeros(batch.num_rows, dtype=np.int64)
        for c in by:
            found = pc.dictionary_encode(batch.column(c), null_encoding="encode")
            codes = codes * len(found.dictionary) + found.indices.to_numpy()
            codes = np.unique(codes, return_inverse=True)[1]
        return codes

    def parts(codes, first, last):
        """Ranges of rows, which lie by code, whose groups and days fit into the cells; one group always does."""
        todo = [(0, len(codes))]
        while todo:
            i, j = todo.pop()
            width = int(last[i:j].max()) - int(first[i:j].min()) + 1
            if codes[i] == codes[j - 1] or (int(codes[j - 1] - codes[i]) + 1) * width <= most_cells:
                yield i, j, width
            else:
                todo += [(i, (i + j) // 2), ((i + j) // 2, j)]

    def add(total, places, weights, lengths):
        """Whole numbers add up exactly as doubles below 2**53, and on their own beyond."""
        most = max(abs(int(weights.max())), abs(int(weights.min())))
        if most * len(places) < 1 << 53:
            total += np.bincount(places, np.repeat(weights.astype(np.float64), lengths), len(total)).astype(np.int64)
        else:
            np.add.at(total, places, np.repeat(weights, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = groups(batch)
            order = np.argsort(codes, kind="stable")
            batch, codes = batch.take(pa.array(order)), codes[order]
            first, last = (batch.column(c).cast(pa.int32()).to_numpy().astype(np.int64) for c in ("_first", "_last"))
            lengths = last - first + 1
            columns = [batch.column(m) for m in measures]
            known = [c.is_valid().to_numpy(zero_copy_only=False) if c.null_count else None for c in columns]
            numbers = [c.fill_null(0).to_numpy() for c in columns]
            for i, j, width in parts(codes, first, last):
                begin, cells = int(first[i:j].min()), (int(codes[j - 1] - codes[i]) + 1) * width
                versions = np.zeros(cells, dtype=np.int64)
                sums = [np.zeros(cells, dtype=np.int64) for _ in measures]
                counts = [None if k is None else np.zeros(cells, dtype=np.int64) for k in known]
                starts = (codes[i:j] - codes[i]) * width + first[i:j] - begin
                ends = np.cumsum(lengths[i:j])
                a = 0
                while a < j - i:
                    done = int(ends[a - 1]) if a else 0
                    b = max(a + 1, int(np.searchsorted(ends, done + max(unfolded, cells), side="right")))
                    each = lengths[i + a:i + b]
                    places = np.arange(int(ends[b - 1]) - done) + np.repeat(starts[a:b] - (ends[a:b] - each - done), each)
                    versions += np.bincount(places, minlength=cells)
                    for total, number, count, valid in zip(sums, numbers, counts, known):
                        add(total, places, number[i + a:i + b], each)
                        if count is not None:
                            add(count, places, valid[i + a:i + b].astype(np.int64), each)
                    a = b
                kept = np.flatnonzero(versions)
                where = np.searchsorted(codes, codes[i] + kept // width)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(where)) for c in by],
                     pa.array((begin + kept % width).astype(np.int32)).cast(pa.date32()), pa.array(versions[kept]),
                     *[pa.array(total[kept], mask=None if count is None else count[kept] == 0)
                       for total, count in zip(sums, counts)]],
                    [*by, "snapshot_date", "versions", *measures])

    return run


def _valid_days(rows: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Add the first and last midnight in ``[start, end]`` at which a version is valid."""
    begins = F.col("valid_from").cast("date")
    first = F.when(begins.cast("timestamp_ntz") == F.col("valid_from"), begins).otherwise(F.date_add(begins, 1))
    ends = F.col("valid_to").cast("date")
    last = F.when(F.col("valid_to").isNull(), day(end)).otherwise(
        F.when(ends.cast("timestamp_ntz") < F.col("valid_to"), ends).otherwise(F.date_sub(ends, 1)))
    spans = rows.withColumns({"_first": F.greatest(first, day(start)), "_last": F.least(last, day(end))})
    return spans.filter(F.col("_last") >= F.col("_first"))


def snapshot_totals(history: DataFrame, start: date | str, end: date | str, by: Sequence[str],
                    measures: Sequence[str]) -> DataFrame:
    """Versions valid at midnight per day and ``by``: their count and the sums of ``measures``.

    The totals of ``daily_snapshot_append`` without its rows: a version adds itself on its
    first day and takes itself off after its last, and days are summed up along the line.
    """
    by = list(by)
    dated = _valid_days(history, start, end)
    plus = [F.lit(1).cast("bigint").alias("versions"), *[F.col(m) for m in measures]]
    minus = [F.lit(-1).cast("bigint").alias("versions"), *[(-F.col(m)).alias(m) for m in measures]]
    changes = dated.select(*by, F.explode(F.array(
        F.struct(F.col("_first").alias("snapshot_date"), *plus),
        F.struct(F.date_add("_last", 1).alias("snapshot_date"), *minus))).alias("c")).select(*by, "c.*")
    names = ["versions", *measures]
    summed = (changes.filter(F.col("snapshot_date") <= day(end)).groupBy(*by, "snapshot_date")
              .agg(*[F.sum(n).alias(n) for n in names]))
    line = Window.partitionBy(*by).orderBy("snapshot_date")
    to_date = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steady = summed.select(*by, "snapshot_date", *[F.sum(n).over(to_date).alias(n) for n in names],
                           F.coalesce(F.date_sub(F.lead("snapshot_date").over(line), 1), day(end)).alias("_until"))
    return steady.filter(F.col("versions") > 0).select(
        *by, *names, F.explode(F.sequence("snapshot_date", "_until")).alias("snapshot_date"))


def attribute_change_log(versions: DataFrame, key: str, ts: str, attribute: str,
                         tiebreak: Sequence[str] = (), width: str = "hour") -> DataFrame:
    """One row per change of one attribute: old value, new value, when."""
    spans = scd2_from_history(versions, key, ts, [attribute], tiebreak, width)
    seen = with_previous(spans.select(key, "valid_from", attribute), key, ["valid_from"], [attribute], width,
                         hot_keys(versions, key))
    return seen.filter("has_previous").select(key, F.col(f"previous_{attribute}").alias("old_value"),
                                              F.col(attribute).alias("new_value"),
                                              F.col("valid_from").alias("changed_at"))
