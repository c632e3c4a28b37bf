"""Operator 5: mixing sources to target weights by hash thresholds, without sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD, join_few
from tidemark.session import checkpointed

# A hash has 60 bits; each level of the histogram looks at 12 of them.
BITS, LEVEL_BITS = 60, 12


def words(text: Column) -> Column:
    """Words in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ticket(*columns: Column) -> Column:
    """A number below 2**60 that stands for a row's place in its source; equal rows share it."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - BITS)


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, take the weights in turn and share ``share`` times all
    sizes.  A target stops at ``most`` times its source's size; what it leaves is shared
    again by weight.  With sources sorted by the level at which they stop, the common level
    of the others is the first quotient (rest of the budget / rest of the weights) that does not
    pass its own source's stop.  Windows here run over one row per source.
    """
    if share > most:
        raise ValueError("the share cannot exceed the cap")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    weighted = sizes.select("source", "source_size", turn.alias("w"))
    stop = F.col("source_size") * F.lit(float(most))
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy(stop / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum(stop).over(before), F.lit(0.0))
    level = left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    tried = weighted.select("source", "source_size", "w", level.alias("level"), (stop / F.col("w")).alias("stop"))
    common = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "level"))).over(everything)
    return tried.select("source", "source_size", F.least(
        F.col("source_size") * F.lit(float(most)),
        F.coalesce(common["level"], F.col("stop")) * F.col("w")).alias("target"))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, source_size, target, whole, below``: how often a source is taken whole, and up to which ticket again.

    ``sized`` has ``source, size, ticket``.  Level by level, sizes are summed by source and the
    next 12 bits of the ticket; the bucket in which the running sum passes the rest of
    the target is the only one that the next level reads.  It ends when no boundary bucket
    holds two tickets; the last bucket goes in if that comes nearer to the target.
    """
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    state = checkpointed(plan.select(
        "source", "source_size", "target", whole.cast("bigint").alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("rest"), F.lit(0).cast("bigint").alias("low"),
        F.lit(False).alias("done"), F.lit(0).cast("bigint").alias("below")), "mix")
    kept = ("source", "source_size", "target", "whole")
    n = state.count()
    for shift in range(BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        width = 1 << shift
        open_ = state.filter(~F.col("done")).select(F.col("source").alias("_s"), "rest", "low")
        inside = join_few(sized, open_, F.col("source").eqNullSafe(F.col("_s")), rows=n).filter(
            F.shiftright("ticket", shift + LEVEL_BITS) == F.shiftright("low", shift + LEVEL_BITS))
        histogram = inside.groupBy("source", F.shiftright("ticket", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("ticket").alias("first"), F.max("ticket").alias("last"))
        order = Window.partitionBy("source").orderBy("bucket")
        sums = histogram.withColumn("upto", F.sum("size").over(order)).select(
            F.col("source").alias("_s"), "bucket", "size", "upto", (F.col("first") == F.col("last")).alias("single"))
        crossing = (
            join_few(sums, state.select("source", "rest"), F.col("_s").eqNullSafe(F.col("source")), rows=n)
            .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")) & (F.col("size") > 0))
            .select("_s", F.col("bucket").alias("_b"), (F.col("upto") - F.col("size")).alias("_before"),
                    F.col("size").alias("_size"), "single"))
        joined = state.join(crossing, F.col("source").eqNullSafe(F.col("_s")), "left")
        low = F.shiftleft("_b", shift)
        rest = F.col("rest") - F.col("_before")
        closed = F.col("single") | F.lit(shift == 0)
        nearer = F.when(F.col("_size") - rest < rest, low + width).otherwise(low)
        # No crossing: nothing is left to take, or rounding put the rest past the last bucket.
        none = F.col("low") + F.when(F.col("rest") > 0, F.lit(width << LEVEL_BITS)).otherwise(F.lit(0))
        state = checkpointed(joined.select(
            *kept, F.when(F.col("done") | F.col("_b").isNull(), F.col("rest")).otherwise(rest).alias("rest"),
            F.when(F.col("done") | F.col("_b").isNull(), F.col("low")).otherwise(low).alias("low"),
            (F.col("done") | F.col("_b").isNull() | closed).alias("done"),
            F.when(F.col("done"), F.col("below")).when(F.col("_b").isNull(), none)
            .when(closed, nearer).otherwise(F.lit(0).cast("bigint")).alias("below")), "mix")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select(*kept, "below")


def taken(sized: DataFrame, state: DataFrame) -> DataFrame:
    """``sized`` with ``source_size, target, copies``: how often the mix takes each row."""
    few = state.select(F.col("source").alias("_s"), "source_size", "target", "whole", "below")
    again = F.when(F.col("ticket") < F.col("below"), 1).otherwise(0)
    return (join_few(sized, few, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("copies", F.col("whole") + again).drop("_s", "whole", "below"))


def plan(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets and thresholds of a table ``source, size, ticket``; one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, targets(sizes, weights, share, most))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size, source_size, target, taken``: the words of each row that the mix takes.

    Rows are taken whole, as often as the target is of the source's size, and once more
    below the source's ticket threshold.  The ticket hashes id and text, so repeated rows share
    their fate and reruns agree.  Null texts have size 0; the null source is a source;
    columns of ``docs`` named like the new ones give way.  An empty table stays empty.
    """
    measured = docs.select(F.col(source).alias("source"), words(F.col(text)).alias("size"),
                           ticket(F.col(doc_id), F.col(text)).alias("ticket"))
    state = plan(checkpointed(measured, "sizes"), weights, share, most)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(source).alias("source"), words(F.col(text)).alias("size"),
                        ticket(F.col(doc_id), F.col(text)).alias("ticket"))
    mixed = taken(keyed, state).select("_row", "size", "source_size", "target", "copies")
    gone = {"size", "source_size", "target", "taken"}
    return mixed.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in gone],
                        "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def apply_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: not at all, once or repeated."""
    measured = docs.select(F.col("source"), words(F.col("text")).alias("size"),
                           ticket(F.col("doc_id"), F.col("text")).alias("ticket"))
    state = plan(checkpointed(measured, "sizes"), weights, share, most)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("source").alias("source"),
                        ticket(F.col("doc_id"), F.col("text")).alias("ticket"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    repeated = taken(keyed, state).filter("copies > 0").select("_row", copies.alias("_copy"))
    return repeated.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def mix_digest(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
               most: float = 2.0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` alone: texts are read once."""
    sized = checkpointed(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                                     ticket(F.col("doc_id"), F.col("text")).alias("ticket")), "sizes")
    state = plan(sized.select("source", "size", "ticket"), weights, share, most)
    return taken(sized, state).select("doc_id", "size", "source_size", "target",
                                      (F.col("size") * F.col("copies")).alias("taken"))
