"""Ordered funnels from one scan: step transitions per user and minute, put together along time.

What a stretch of a user's time does to a funnel is a short list per number of steps done before it: the times at which
further steps are reached.  Lists of stretches in a row combine, so events shrink to minutes, minutes to days and
days to users.  No group is larger than a minute's different times, a day's minutes or the range's days, whoever owns
the events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import micros, period_start
from tidemark.functions.values import ratio
from tidemark.operators.product import events_between

_MINUTE, _DAY = 60_000_000, 86_400_000_000


def _nothing(steps: int) -> Column:
    return F.array(*[F.array().cast("array<bigint>") for _ in range(steps)])


def _after_event(lists: Column, event: Column, strict: bool) -> Column:
    """Each list goes on if the event is its next step and comes after its last one."""
    def goes_on(reached: Column, done: Column) -> Column:
        last = F.element_at(reached, -1)
        later = (F.size(reached) == 0) | ((last < event["t"]) if strict else (last <= event["t"]))
        return F.when((done + F.size(reached) == event["step"]) & later, F.concat(reached, F.array(event["t"]))).otherwise(reached)

    return F.transform(lists, goes_on)


def _joined(lists: Column, following: Column, steps: int) -> Column:
    """What two stretches in a row do: the second goes on where the first one ends."""
    def goes_on(reached: Column, done: Column) -> Column:
        at = done + F.size(reached)
        return F.when(at < steps, F.concat(reached, F.get(following, at))).otherwise(reached)

    return F.transform(lists, goes_on)


def _along(rows: DataFrame, keys: Sequence[str], order: str, steps: int) -> DataFrame:
    """The lists of all stretches of each key, in order, put together."""
    ordered = F.array_sort(F.collect_list(F.struct(order, "lists")))
    whole = F.aggregate(ordered, _nothing(steps), lambda acc, x: _joined(acc, x["lists"], steps))
    return rows.groupBy(*keys).agg(whole.alias("lists"))


def step_times(events: DataFrame, start: date | str, end: date | str, steps: Sequence[str], strict: bool = True,
               user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """``user, reached``: the times (microseconds) at which each user first reaches the steps, one after another.

    The first step is reached at its first event, each other at its first event after (``strict``) or not before the
    time of the previous one.  Users that never reach the first step are not listed; rows without user or time are left
    out.  A name may stand for several steps.
    """
    n = len(steps)
    which = F.array_compact(F.array(*[F.when(F.col("event_name") == s, F.lit(i)) for i, s in enumerate(steps)]))
    hits = (events_between(events, start, end)
            .filter(F.col("event_name").isin(*dict.fromkeys(steps)) & F.col(user).isNotNull() & F.col(ts).isNotNull())
            .select(F.col(user), micros(F.col(ts)).alias("t"), F.explode(which).alias("step")))
    times = F.array_sort(F.collect_set(F.struct("t", "step")))
    minutes = (hits.groupBy(user, F.floor(F.col("t") / F.lit(_MINUTE)).alias("minute"))
               .agg(F.aggregate(times, _nothing(n), lambda acc, e: _after_event(acc, e, strict)).alias("lists")))
    days = _along(minutes.withColumn("day", F.floor(F.col("minute") / F.lit(_DAY // _MINUTE))), [user, "day"], "minute", n)
    whole = _along(days, [user], "day", n)
    return whole.select(user, F.get("lists", F.lit(0)).alias("reached")).filter(F.size("reached") > 0)


def _within(hours: int) -> Column:
    """How many steps are reached in time; later steps come later, so they are the first ones."""
    limit = F.get("reached", F.lit(0)) + F.lit(hours * 3_600_000_000).cast("bigint")
    return F.size(F.filter("reached", lambda t: t <= limit))


def ordered_funnel(events: DataFrame, start: date | str, end: date | str, steps: Sequence[str], within_hours: int = 168,
                   user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Users that reach each step in order within ``within_hours`` of the first: ``event_funnel`` from one scan."""
    done = step_times(events, start, end, steps, True, user, ts).select(_within(within_hours).alias("done"))
    counts = done.agg(*[F.count(F.when(F.col("done") >= i, 1)).alias(f"s{i}") for i in range(1, len(steps) + 1)])
    rows = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("event_name"), F.col(f"s{i}").alias("users"),
                     ratio(F.col(f"s{i}"), F.col("s1")).alias("conversion_from_start"),
                     ratio(F.col(f"s{i}"), F.col(f"s{max(1, i - 1)}")).alias("conversion_from_previous"))
            for i, name in enumerate(steps, start=1)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def ordered_activation(events: DataFrame, start: date | str, end: date | str, signup: str, activation: str,
                       within_hours: int = 168, user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Per week of the first signup, users whose activation follows in time: ``activation_rate`` from one scan."""
    chains = step_times(events, start, end, (signup, activation), False, user, ts)
    signed_up = F.timestamp_add("MICROSECOND", F.get("reached", F.lit(0)), F.lit("1970-01-01").cast("timestamp_ntz"))
    return (chains.select(period_start(signed_up, "week").alias("signup_week"), (_within(within_hours) > 1).alias("active"))
            .groupBy("signup_week").agg(F.count("*").alias("signups"), F.count(F.when(F.col("active"), 1)).alias("activated"))
            .withColumn("activation_rate", ratio(F.col("activated"), F.col("signups"))))
