"""Engagement, adoption, sessions, funnels and retention out of product events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import day, micros, period_start, periods
from tidemark.functions.values import ratio
from tidemark.operators.relational import count_of, distinct_values, not_in_events
from tidemark.operators.skew import spread_join


def events_between(events: DataFrame, start: date | str, end: date | str,
                   date_column: str = "event_date") -> DataFrame:
    """Events of ``[start, end]``.  Both ends are required, so no scan is unbounded."""
    if start is None or end is None:
        raise ValueError("events need a start and an end date")
    return events.filter((F.col(date_column) >= day(start)) & (F.col(date_column) <= day(end)))


def account_engagement(events: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Day x account: distinct users, events, distinct sessions, sorted feature names.

    One shuffle of distinct values carries all counts; a dominant account is spread by its
    users and sessions, and the second grouping only adds up partial results.
    """
    return _engagement(engagement_parts(events_between(events, start, end)))


def engagement_parts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What ``account_engagement`` is made of: distinct users, sessions and event names per day and account, with their
    rows.  Parts of several loads (``by``) add up, see ``engagement_of_parts``."""
    active = not_in_events(events).withColumnRenamed("event_date", "activity_date")
    return distinct_values(active, ["activity_date", "account_id", *by], ["user_id", "session_id", "event_name"])


def engagement_of_parts(parts: DataFrame) -> DataFrame:
    """``account_engagement`` from the parts of any number of loads."""
    return _engagement(parts.groupBy("activity_date", "account_id", "kind", "value").agg(F.sum("n").alias("n")))


def _engagement(values: DataFrame) -> DataFrame:
    named = F.col("kind") == "event_name"
    return values.groupBy("activity_date", "account_id").agg(
        count_of("user_id").alias("dau"), F.sum(F.when(named, F.col("n"))).alias("event_count"),
        count_of("session_id").alias("sessions"),
        F.array_sort(F.collect_set(F.when(named, F.col("value")))).alias("features_used"))


def account_engagement_approx(events: DataFrame, start: date | str, end: date | str, rsd: float = 0.02) -> DataFrame:
    """The same with HyperLogLog counts: one pass, fixed-size state."""
    active = not_in_events(events_between(events, start, end))
    return active.groupBy(F.col("event_date").alias("activity_date"), "account_id").agg(
        F.approx_count_distinct("user_id", rsd).alias("dau"), F.count("*").alias("event_count"),
        F.approx_count_distinct("session_id", rsd).alias("sessions"),
        F.array_sort(F.collect_set("event_name")).alias("features_used"))


def engagement_daily(accounts: DataFrame) -> DataFrame:
    """Day: sum of account DAU and number of accounts."""
    return accounts.groupBy("activity_date").agg(
        F.sum("dau").alias("dau"), F.count_distinct("account_id").alias("active_accounts"))


def rolling_sum(daily: DataFrame, value: str, name: str, n: int = 30, by: Sequence[str] = (),
                order: str = "activity_date") -> DataFrame:
    """Sum over the last ``n`` *rows*.  The input holds one row per day (and ``by``)."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(n - 1), Window.currentRow)
    return daily.withColumn(name, F.sum(value).over(w))


def stickiness(dau: Column, mau: Column) -> Column:
    return ratio(dau, mau)


def daily_engagement(accounts: DataFrame) -> DataFrame:
    """The day mart: DAU, accounts, the 30-row sum that stands in for MAU, and their ratio."""
    rolled = rolling_sum(engagement_daily(accounts), "dau", "mau")
    return rolled.withColumn("dau_mau_ratio", stickiness(F.col("dau"), F.col("mau")))


def account_daily_engagement(accounts: DataFrame) -> DataFrame:
    """The same at account x day."""
    rolled = rolling_sum(accounts, "dau", "mau", by=["account_id"])
    return rolled.select("account_id", "activity_date", "dau", "mau", "event_count", "sessions",
                         stickiness(F.col("dau"), F.col("mau")).alias("dau_mau_ratio"))


def rolling_distinct(events: DataFrame, start: date | str, end: date | str, n: int = 30,
                     by: Sequence[str] = (), user: str = "user_id") -> DataFrame:
    """Exact distinct users of the last ``n`` days, for every day of ``[start, end]``.

    A user is counted on day d when one of the user's days lies in [d-n+1, d].  Cutting each
    day's reach at the user's next active day makes those intervals disjoint, so the count is
    a sweep: plus one when an interval opens, minus one when it closes.  User-days are
    distinct with map-side combine, the per-user window holds one row per day at most, and
    nothing is exploded to its ``n`` covering days.
    """
    by = list(by)
    days = (events_between(events, start, end).filter(F.col(user).isNotNull())
            .select(*by, user, F.col("event_date").alias("opens")).distinct())
    line = Window.partitionBy(*by, user).orderBy("opens")
    spans = days.withColumn("closes", F.least(F.date_add("opens", n), F.lead("opens").over(line)))
    changes = spans.select(*by, F.explode(F.array(
        F.struct(F.col("opens").alias("activity_date"), F.lit(1).alias("change")),
        F.struct(F.col("closes").alias("activity_date"), F.lit(-1).alias("change")))).alias("c")
    ).select(*by, "c.*").filter(F.col("activity_date") <= day(end))
    calendar = F.explode(periods(day(start), day(end))).alias("activity_date")
    grid = (days.select(*by).distinct() if by else events.sparkSession.range(1)).select(
        *by, calendar, F.lit(0).alias("change"))
    daily = changes.unionByName(grid).groupBy(*by, "activity_date").agg(F.sum("change").alias("change"))
    to_date = Window.partitionBy(*by).orderBy("activity_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return daily.select(*by, "activity_date", F.sum("change").over(to_date).alias("mau"))


def active_users(events: DataFrame, start: date | str, end: date | str, n: int = 30) -> DataFrame:
    """Day: distinct users (``dau``) and distinct users of the last ``n`` days (``mau``), each counted once however
    many accounts they have.  Days without activity have zero users."""
    active = not_in_events(events)
    today = (events_between(active, start, end).select(F.col("event_date").alias("activity_date"), "user_id").distinct()
             .groupBy("activity_date").agg(F.count("user_id").alias("dau")))
    rolled = rolling_distinct(active, start, end, n)
    return rolled.join(today, "activity_date", "left").select(
        "activity_date", F.coalesce("dau", F.lit(0)).cast("bigint").alias("dau"), "mau")


def rolling_distinct_approx(events: DataFrame, start: date | str, end: date | str, n: int = 30,
                            by: Sequence[str] = (), user: str = "user_id", lg_k: int = 12) -> DataFrame:
    """``rolling_distinct`` with HyperLogLog sketches: one per day, merged over the days it reaches.

    Only sketches are repeated ``n`` times, never events or users.
    """
    daily = (events_between(events, start, end).filter(F.col(user).isNotNull())
             .groupBy(*by, F.col("event_date").alias("opens")).agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("sketch")))
    reach = periods(F.col("opens"), F.least(F.date_add("opens", n - 1), day(end)))
    return (daily.select(*by, "sketch", F.explode(reach).alias("activity_date")).groupBy(*by, "activity_date")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("mau")))


def feature_adoption_daily(events: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Day x feature: distinct users and accounts; no event name is left out."""
    keys = ["activity_date", "feature_name"]
    used = events_between(events, start, end).select(
        F.col("event_date").alias("activity_date"), F.col("event_name").alias("feature_name"), "user_id", "account_id")
    return distinct_values(used, keys, ["user_id", "account_id"]).groupBy(*keys).agg(
        count_of("user_id").alias("feature_users"), count_of("account_id").alias("accounts_using"))


def feature_adoption_pct(events: DataFrame, start: date | str, end: date | str,
                         by: Sequence[str] = ()) -> DataFrame:
    """Month x feature: share of the month's active users that used the feature.

    Both counts come from one set of distinct (month, feature, user) rows.
    """
    by, month = list(by), period_start(F.col("event_date"), "month").alias("activity_month")
    used = (not_in_events(events_between(events, start, end)).filter(F.col("user_id").isNotNull())
            .select(month, *by, F.col("event_name").alias("feature_name"), "user_id").distinct())
    per_feature = used.groupBy("activity_month", *by, "feature_name").agg(F.count("*").alias("feature_users"))
    active = used.groupBy("activity_month", *by).agg(F.count_distinct("user_id").alias("mau"))
    return per_feature.join(active, ["activity_month", *by]).withColumn(
        "adoption_pct", ratio(F.col("feature_users"), F.col("mau")))


def sessionize(events: DataFrame, start: date | str, end: date | str, gap_minutes: int = 30,
               user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Sessions of each user: a pause longer than ``gap_minutes`` starts a new one.

    Two events inside one clock-aligned slot of ``gap_minutes`` always share a session, so
    the first and last event and the count of each (user, slot) are all that is needed.
    These come out of a map-side combine: however many events a user has, the window per
    user sees at most one row per slot.
    """
    gap = gap_minutes * 60_000_000
    at = micros(F.col(ts))
    slots = (events_between(events, start, end).filter(F.col(user).isNotNull() & F.col(ts).isNotNull())
             .groupBy(user, F.floor(at / F.lit(gap)).alias("slot"))
             .agg(F.min(ts).alias("t0"), F.max(ts).alias("t1"), F.min(at).alias("m0"), F.max(at).alias("m1"),
                  F.count("*").alias("n")))
    line = Window.partitionBy(user).orderBy("slot")
    opens = F.coalesce(F.col("m0") - F.lag("m1").over(line) > gap, F.lit(True))
    to_date = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (slots.withColumn("_opens", opens.cast("int"))
                .withColumn("session_number", F.sum("_opens").over(to_date)))
    return numbered.groupBy(user, "session_number").agg(
        F.min("t0").alias("session_start"), F.max("t1").alias("session_end"), F.sum("n").alias("events"))


def session_ids(events: DataFrame, start: date | str, end: date | str, gap_minutes: int = 30,
                user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Each event with the number of its session.

    Sessions are looked up by (user, slot of the event): a session is repeated once per slot
    it touches, at most two sessions meet in one slot, and the events of a heavy user are
    spread over its slots.
    """
    gap = gap_minutes * 60_000_000

    def slot(column: str) -> Column:
        return F.floor(micros(F.col(column)) / F.lit(gap))

    found = sessionize(events, start, end, gap_minutes, user, ts)
    reach = found.select(F.col(user), "session_number", "session_start", "session_end",
                         F.explode(F.sequence(slot("session_start"), slot("session_end"))).alias("_slot"))
    keyed = events_between(events, start, end).withColumn("_slot", slot(ts))
    joined = keyed.join(reach, [user, "_slot"], "left")
    inside = F.col("session_number").isNull() | F.col(ts).between(F.col("session_start"), F.col("session_end"))
    return joined.filter(inside).select(*events.columns, "session_number")


def event_funnel(events: DataFrame, start: date | str, end: date | str, steps: Sequence[str],
                 within_hours: int = 168, user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Users that reach each step in order, all within ``within_hours`` of the first.

    A step is reached at its first event after the previous step.  Only users that reached
    a step go on, and each join spreads the hot users of the event side.
    """
    scoped = events_between(events, start, end).filter(F.col(user).isNotNull()).select(
        user, "event_name", F.col(ts).alias("ts"))
    limit = F.expr(f"interval {int(within_hours)} hours")
    reached = (scoped.filter(F.col("event_name") == steps[0]).groupBy(user)
               .agg(F.min("ts").alias("first_at")).withColumn("at", F.col("first_at")))
    stages = [reached]
    for name in steps[1:]:
        hits = scoped.filter(F.col("event_name") == name).select(user, "ts")
        later = spread_join(hits, reached, user, "inner", spread_by=["ts"]).filter(
            (F.col("ts") > F.col("at")) & (F.col("ts") <= F.col("first_at") + limit))
        reached = later.groupBy(user).agg(F.min("ts").alias("at"), F.min("first_at").alias("first_at"))
        stages.append(reached)
    counts = None
    for i, (name, stage) in enumerate(zip(steps, stages), start=1):
        row = stage.agg(F.count("*").alias("users")).select(
            F.lit(i).alias("step"), F.lit(name).alias("event_name"), "users")
        counts = row if counts is None else counts.unionByName(row)
    # One row per step: the windows below run over a handful of rows.
    line = Window.orderBy("step")
    return counts.withColumn("conversion_from_start", ratio(F.col("users"), F.first("users").over(line))).withColumn(
        "conversion_from_previous", ratio(F.col("users"), F.coalesce(F.lag("users").over(line), F.col("users"))))


def retention(events: DataFrame, start: date | str, end: date | str, grain: str = "week",
              user: str = "user_id") -> DataFrame:
    """Share of each first-seen cohort that is active again k periods later.

    Users shrink to distinct (user, period) rows first; the window per user then holds one
    row per period.
    """
    days = {"day": 1, "week": 7}
    seen = (events_between(events, start, end).filter(F.col(user).isNotNull())
            .select(user, period_start(F.col("event_date"), grain).alias("period")).distinct())
    first = seen.withColumn("cohort", F.min("period").over(Window.partitionBy(user)))
    if grain in days:
        k = (F.datediff("period", "cohort") / F.lit(days[grain])).cast("bigint")
    else:
        k = F.round(F.months_between("period", "cohort")).cast("bigint")
        if grain != "month":
            raise ValueError("retention works by day, week or month")
    counted = first.groupBy("cohort", k.alias("k")).agg(F.count("*").alias("active_users"))
    size = F.first("active_users").over(Window.partitionBy("cohort").orderBy("k"))
    return counted.withColumn("cohort_users", size).withColumn(
        "retention_rate", ratio(F.col("active_users"), F.col("cohort_users")))


def activation_rate(events: DataFrame, start: date | str, end: date | str, signup: str, activation: str,
                    within_hours: int = 168, user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Per signup week: users whose activation follows their first signup in time."""
    scoped = events_between(events, start, end).filter(F.col(user).isNotNull()).select(
        user, "event_name", F.col(ts).alias("ts"))
    signups = scoped.filter(F.col("event_name") == signup).groupBy(user).agg(F.min("ts").alias("signed_up_at"))
    limit = F.expr(f"interval {int(within_hours)} hours")
    hits = scoped.filter(F.col("event_name") == activation).select(user, "ts")
    active = (spread_join(hits, signups, user, "inner", spread_by=["ts"])
              .filter((F.col("ts") >= F.col("signed_up_at")) & (F.col("ts") <= F.col("signed_up_at") + limit))
              .select(user).distinct().withColumn("activated", F.lit(1)))
    return (signups.join(active, user, "left")
            .groupBy(period_start(F.col("signed_up_at"), "week").alias("signup_week"))
            .agg(F.count("*").alias("signups"), F.count("activated").alias("activated"))
            .withColumn("activation_rate", ratio(F.col("activated"), F.col("signups"))))


def exclude_bots(events: DataFrame, start: date | str, end: date | str, internal_users: DataFrame,
                 max_per_hour: int, user: str = "user_id", ts: str = "event_timestamp") -> DataFrame:
    """Events without listed users and without users above ``max_per_hour`` in any clock hour.

    The anti-join spreads the events of heavy users, bots above all.
    """
    scoped = events_between(events, start, end)
    fast = (scoped.filter(F.col(user).isNotNull()).groupBy(user, F.date_trunc("hour", ts).alias("_hour"))
            .agg(F.count("*").alias("n")).filter(F.col("n") > max_per_hour).select(user).distinct())
    unwanted = fast.unionByName(internal_users.select(user))
    return spread_join(scoped, unwanted, user, "left_anti", spread_by=[ts])


def match_rate(events: DataFrame, accounts: DataFrame, start: date | str, end: date | str,
               target: float = 0.95) -> DataFrame:
    """One row: share of events, and of account ids, that link to a known account.

    Events shrink to one counted row per account id before they meet the accounts.
    """
    per_id = events_between(events, start, end).groupBy("account_id").agg(F.count("*").alias("n"))
    known = accounts.select("account_id", F.lit(True).alias("known")).distinct()
    linked = per_id.join(known, "account_id", "left")
    return linked.agg(
        F.sum("n").alias("events"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("matched"),
        F.count("account_id").alias("account_ids"), F.count("known").alias("matched_ids"),
    ).withColumn("event_match_rate", ratio(F.col("matched"), F.col("events"))).withColumn(
        "id_match_rate", ratio(F.col("matched_ids"), F.col("account_ids"))).withColumn(
        "meets_target", F.col("event_match_rate") >= target)
