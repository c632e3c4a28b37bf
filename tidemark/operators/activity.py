"""Days of activity as bitmaps: daily and rolling users, stickiness and retention without a second look at the events.

A user's days are bits of 32-day words, eight bytes for each month or so in which the user was active.  Bitmaps of
different periods or sources merge by OR.  What follows from them costs one narrow row per user and word.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import day, period_start
from tidemark.functions.values import ratio
from tidemark.operators.product import events_between

WORD = 32
# Words are counted from here.
_ORIGIN = "1970-01-01"


def _number(value: Column) -> Column:
    return F.datediff(value, day(_ORIGIN)).cast("bigint")


def _date(number: Column) -> Column:
    return F.date_add(day(_ORIGIN), number.cast("int"))


def _bit(bits: Column, at: int) -> Column:
    return F.shiftrightunsigned(bits, at).bitwiseAND(F.lit(1).cast("bigint"))


def activity_bitmaps(events: DataFrame, start: date | str, end: date | str, user: str = "user_id") -> DataFrame:
    """``user, word, bits``: the days of ``[start, end]`` on which each user has an event.

    One hash aggregate with map-side combine; rows without a user are left out.
    """
    number = _number(F.col("event_date"))
    seen = events_between(events, start, end).filter(F.col(user).isNotNull()).select(
        F.col(user), F.floor(number / WORD).alias("word"), F.pmod(number, F.lit(WORD)).cast("int").alias("_at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_at"))
    return seen.groupBy(user, "word").agg(F.bit_or(one).alias("bits"))


def merge_bitmaps(one: DataFrame, two: DataFrame, user: str = "user_id") -> DataFrame:
    """Bitmaps of both; days that both hold count once."""
    return one.unionByName(two).groupBy(user, "word").agg(F.bit_or("bits").alias("bits"))


def active_by_day(bitmaps: DataFrame, start: date | str, end: date | str, n: int = 30, user: str = "user_id") -> DataFrame:
    """``activity_date, dau, mau, stickiness``: users of each day of ``[start, end]`` and of the ``n`` (at most 32) days up to it.

    Each word meets the one before it by being listed twice, so one shuffle of narrow rows carries all days; the counts
    of a word's 32 days are sums in one row.  Days without users count zero.
    """
    if not 1 <= n <= WORD:
        raise ValueError(f"a window has 1 to {WORD} days")
    none = F.lit(0).cast("bigint")
    twice = bitmaps.select(user, F.explode(F.array(
        F.struct(F.col("word"), F.col("bits").alias("now"), none.alias("before")),
        F.struct((F.col("word") + 1).alias("word"), none.alias("now"), F.col("bits").alias("before")))).alias("w")).select(user, "w.*")
    met = twice.groupBy(user, "word").agg(F.bit_or("now").alias("now"), F.bit_or("before").alias("before"))
    # Day d of the word is bit 32 + d of the line; its window are the n bits up to it.
    line = F.col("before").bitwiseOR(F.shiftleft("now", WORD))
    window = F.lit((1 << n) - 1).cast("bigint")
    sums = [x for d in range(WORD) for x in (
        F.sum(_bit(F.col("now"), d)).alias(f"d{d}"),
        F.count(F.when(F.shiftrightunsigned(F.col("line"), WORD + d - n + 1).bitwiseAND(window) != 0, 1)).alias(f"m{d}"))]
    words = met.withColumn("line", line).groupBy("word").agg(*sums)
    days = F.explode(F.array(*[F.struct(F.lit(d).alias("at"), F.col(f"d{d}").alias("dau"), F.col(f"m{d}").alias("mau"))
                               for d in range(WORD)]))
    counted = words.select("word", days.alias("c")).select(
        _date(F.col("word") * WORD + F.col("c.at")).alias("activity_date"), "c.dau", "c.mau")
    calendar = bitmaps.sparkSession.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("activity_date"))
    zero = F.lit(0).cast("bigint")
    return calendar.join(counted, "activity_date", "left").select(
        "activity_date", F.coalesce("dau", zero).alias("dau"), F.coalesce("mau", zero).alias("mau"),
        ratio(F.col("dau"), F.col("mau")).alias("stickiness"))


def _days(bits: Column) -> Column:
    """The set bits of a word, in order."""
    one = F.lit(1).cast("bigint")
    every = F.sequence(F.lit(0), F.lit(WORD - 1))
    return F.filter(every, lambda i: F.call_function("shiftright", bits, i).bitwiseAND(one) == 1)


def retention_of(bitmaps: DataFrame, grain: str = "day", user: str = "user_id") -> DataFrame:
    """``cohort, k, active_users, cohort_users, retention_rate``, as ``retention`` counts them from events.

    ``grain`` is day, week or month.  A user's words are few, so the window per user is short whatever
    the user did.
    """
    if grain not in ("day", "week", "month"):
        raise ValueError("retention works by day, week or month")
    first = _date(F.min(F.col("word") * WORD + F.element_at(_days(F.col("bits")), 1)).over(Window.partitionBy(user)))
    active = bitmaps.select(user, period_start(first, grain).alias("cohort"), "word", F.explode(_days(F.col("bits"))).alias("at"))
    periods = active.select(user, "cohort", period_start(_date(F.col("word") * WORD + F.col("at")), grain).alias("period"))
    if grain != "day":
        periods = periods.distinct()
    if grain == "month":
        k = F.round(F.months_between("period", "cohort")).cast("bigint")
    else:
        k = (F.datediff("period", "cohort") / F.lit({"day": 1, "week": 7}[grain])).cast("bigint")
    counted = periods.groupBy("cohort", k.alias("k")).agg(F.count("*").alias("active_users"))
    size = F.first("active_users").over(Window.partitionBy("cohort").orderBy("k"))
    return counted.withColumn("cohort_users", size).withColumn(
        "retention_rate", ratio(F.col("active_users"), F.col("cohort_users")))
