"""The metric layer: one registry of models, measures and metrics, compiled to groupBy.agg."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import GRAINS, instant, period_start
from tidemark.functions.values import ratio
from tidemark.operators import sketches
from tidemark.plans.marts import Marts

VERSION = "1.0.0"


@dataclass(frozen=True)
class Measure:
    """``agg`` as defined (sum or average); ``rollup`` how values combine over time when
    sums over time make no sense: ``sum``, ``average`` or ``last``."""

    name: str
    column: str
    agg: str = "sum"
    rollup: str = "sum"


@dataclass(frozen=True)
class SemanticModel:
    name: str
    view: str
    time: str
    grain: str
    entity: str
    dimensions: tuple[str, ...]
    measures: tuple[Measure, ...]
    # The view that the corrected form reads, if it is another one.
    corrected_view: str | None = None
    # A view with one row per period, and the measures that may be read from it when nothing is filtered or split.
    totals_view: str | None = None
    totals: tuple[str, ...] = ()

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    domain: str
    unit: str
    inputs: tuple[str, ...]
    formula: Callable[[Mapping[str, Column]], Column] | None = None


MODELS = (
    SemanticModel("revenue_metrics", "revenue_kpis", "revenue_month", "month", "account_id", ("account_id",), (
        Measure("mrr", "mrr_usd", rollup="last"),
        Measure("arr", "arr_usd", rollup="last")), totals_view="arr_totals", totals=("arr",)),
    SemanticModel("sales_metrics", "sales_kpis", "snapshot_date", "day", "opportunity_id",
                  ("account_id", "stage_name"), (
                      Measure("pipeline_value", "amount_usd", rollup="last"),
                      Measure("weighted_pipeline", "weighted_amount_usd", rollup="last"))),
    SemanticModel("sales_win_rate_metrics", "sales_win_rate", "fiscal_quarter", "quarter", "fiscal_quarter", (), (
        Measure("win_rate", "win_rate", agg="average", rollup="average"),)),
    SemanticModel("marketing_metrics", "marketing_kpis", "activity_month", "month", "activity_month", (), (
        Measure("marketing_spend", "marketing_spend"),
        Measure("new_customers", "new_customers"),
        Measure("ad_spend", "ad_spend"),
        Measure("attributed_revenue", "attributed_revenue"))),
    SemanticModel("finance_metrics", "finance_kpis", "activity_month", "month", "activity_month", (), (
        Measure("revenue", "revenue"),
        Measure("cogs", "cogs"))),
    SemanticModel("product_metrics", "product_kpis", "activity_date", "day", "activity_date", (), (
        Measure("dau", "dau", rollup="average"),
        Measure("mau", "mau", rollup="last")), corrected_view="product_users"),
    SemanticModel("hr_metrics", "hr_kpis", "activity_month", "month", "activity_month", (), (
        Measure("headcount", "headcount", rollup="last"),
        Measure("terminations", "terminations"),
        Measure("avg_headcount", "headcount", agg="average", rollup="average"))),
)


def _over(top: str, bottom: str) -> Callable[[Mapping[str, Column]], Column]:
    return lambda v: ratio(v[top], v[bottom])


METRICS: dict[str, Metric] = {m.name: m for m in (
    Metric("arr", "Annual recurring revenue", "finance", "USD", ("arr",)),
    Metric("mrr", "Monthly recurring revenue", "finance", "USD", ("mrr",)),
    Metric("pipeline_value", "Open pipeline", "sales", "USD", ("pipeline_value",)),
    Metric("win_rate", "Win rate", "sales", "ratio", ("win_rate",)),
    Metric("marketing_spend", "Marketing spend", "marketing", "USD", ("marketing_spend",)),
    Metric("new_customers", "New customers", "marketing", "count", ("new_customers",)),
    Metric("ad_spend", "Ad spend", "marketing", "USD", ("ad_spend",)),
    Metric("attributed_revenue", "Attributed revenue", "marketing", "USD", ("attributed_revenue",)),
    Metric("cac", "Customer acquisition cost", "marketing", "USD", ("marketing_spend", "new_customers"),
           _over("marketing_spend", "new_customers")),
    Metric("roas", "Return on ad spend", "marketing", "ratio", ("attributed_revenue", "ad_spend"),
           _over("attributed_revenue", "ad_spend")),
    Metric("revenue", "Revenue", "finance", "USD", ("revenue",)),
    Metric("cogs", "Cost of goods sold", "finance", "USD", ("cogs",)),
    Metric("gross_margin_pct", "Gross margin", "finance", "ratio", ("revenue", "cogs"),
           lambda v: ratio(v["revenue"] - v["cogs"], v["revenue"])),
    Metric("dau", "Daily active users", "product", "count", ("dau",)),
    Metric("mau", "Monthly active users", "product", "count", ("mau",)),
    Metric("headcount", "Headcount", "hr", "count", ("headcount",)),
    Metric("terminations", "Terminations", "hr", "count", ("terminations",)),
    Metric("attrition_rate", "Attrition rate", "hr", "ratio", ("terminations", "headcount"),
           _over("terminations", "headcount")),
)}

# The series that are served as (period, value).
SERVED = ("arr", "mrr", "pipeline_value", "win_rate", "dau", "mau", "headcount")


def model_of(measure: str) -> SemanticModel:
    for model in MODELS:
        if any(m.name == measure for m in model.measures):
            return model
    raise ValueError(f"unknown measure {measure!r}")


def _check_grain(model: SemanticModel, grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    if GRAINS.index(grain) < GRAINS.index(model.grain):
        raise ValueError(f"{model.name} has {model.grain} rows; it cannot answer by {grain}")


def measures(marts: Marts, model: SemanticModel, names: Sequence[str], grain: str, dims: Sequence[str] = (),
             where: Column | None = None, corrected: bool = False) -> DataFrame:
    """(period, dims, measures): filter, truncate the time, group, aggregate; one pass."""
    _check_grain(model, grain)
    unknown = set(dims) - set(model.dimensions)
    if unknown:
        raise ValueError(f"{model.name} has no dimensions {sorted(unknown)}")
    whole = where is None and not dims and model.totals_view is not None and set(names) <= set(model.totals)
    view = getattr(marts, model.totals_view if whole else corrected and model.corrected_view or model.view)
    if where is not None:
        view = view.filter(where)
    period = period_start(F.col(model.time), grain).alias("period")
    if not corrected:
        agg = {"sum": F.sum, "average": F.avg}
        return view.groupBy(period, *dims).agg(
            *[agg[model.measure(n).agg](model.measure(n).column).alias(n) for n in names])
    # Add up within each of the model's own periods, then combine those over time.
    own = view.groupBy(F.col(model.time).alias("_t"), *dims).agg(
        *[F.sum(model.measure(n).column).alias(n) for n in names])
    combine = {"sum": lambda c: F.sum(c), "average": lambda c: F.avg(c), "last": lambda c: F.max_by(c, F.col("_t"))}
    return own.groupBy(period_start(F.col("_t"), grain).alias("period"), *dims).agg(
        *[combine[model.measure(n).rollup](F.col(n)).alias(n) for n in names])


def _full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on keys of which nulls match nulls."""
    theirs = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(theirs, same, "full").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in keys], *[c for c in left.columns if c not in keys],
        *[c for c in right.columns if c not in keys])


def metric(marts: Marts, name: str | Metric, grain: str | None = None, dims: Sequence[str] = (),
           where: Column | None = None, corrected: bool = False) -> DataFrame:
    """(metric, grain, period, dims, value) of a registered metric, or of one given as such.

    A derived metric evaluates its formula on aggregated inputs and never averages ratios.
    Inputs of one model come out of one aggregate; inputs of several models meet in a full
    join of aggregated rows, in which a null dimension matches a null.
    """
    if not isinstance(name, Metric) and name not in METRICS:
        raise ValueError(f"unknown metric {name!r}")
    wanted = name if isinstance(name, Metric) else METRICS[name]
    by_model: dict[SemanticModel, list[str]] = {}
    for n in wanted.inputs:
        by_model.setdefault(model_of(n), []).append(n)
    grain = grain or max((m.grain for m in by_model), key=GRAINS.index)
    joined = None
    for model, names in by_model.items():
        part = measures(marts, model, names, grain, dims, where, corrected)
        joined = part if joined is None else _full_join(joined, part, ["period", *dims])
    values = {n: F.col(n) for n in wanted.inputs}
    value = wanted.formula(values) if wanted.formula else F.col(wanted.inputs[0])
    return joined.select(F.lit(wanted.name).alias("metric"), F.lit(grain).alias("grain"), "period", *dims,
                         value.cast("double").alias("value"))


def distinct_metric(parts: DataFrame, accounts: DataFrame, grain: str, dims: Sequence[str] = ()) -> DataFrame:
    """(metric, grain, period, dims, value, approximate, standard_error): distinct active users from stored sketches.

    ``parts`` is what ``sketches.distinct_parts`` or a mart of them holds, ``dims`` are columns of ``accounts``; an account that
    is not there has null dimensions.  Any period and dimension counts each user once, where sums of ``dau`` or
    ``mau`` count a user again per account, and no event is read.
    """
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    if dims:
        parts = parts.join(accounts.select("account_id", *[d for d in dims if d != "account_id"]), "account_id", "left")
    counted = sketches.distinct_users(parts, grain, dims)
    return counted.select(F.lit("active_users").alias("metric"), F.lit(grain).alias("grain"), "period", *dims,
                          F.col("active_users").cast("double").alias("value"), "approximate", "standard_error")


def win_rate_exact(marts: Marts, grain: str = "quarter") -> DataFrame:
    """Win rate with the counts added up before dividing, instead of a mean of rates."""
    return (marts.sales_win_counts.groupBy(period_start(F.col("fiscal_quarter"), grain).alias("period"))
            .agg(ratio(F.sum("won_count"), F.sum("closed_count")).alias("value"))
            .select(F.lit("win_rate").alias("metric"), F.lit(grain).alias("grain"), "period", "value"))


def metric_query(marts: Marts, names: Sequence[str] = SERVED) -> DataFrame:
    """The served series in long form, each at its model's own grain.

    Simple metrics of one model come out of one aggregate and are unpivoted, so a mart is
    computed once for all its series.
    """
    result = None
    for model in MODELS:
        own = [n for n in names if METRICS[n].formula is None and model_of(METRICS[n].inputs[0]) is model]
        if not own:
            continue
        wide = measures(marts, model, [METRICS[n].inputs[0] for n in own], model.grain)
        series = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(METRICS[n].inputs[0]).cast("double").alias("value"))
                           for n in own])
        rows = wide.select("period", F.explode(series).alias("s")).select(
            "s.metric", F.lit(model.grain).alias("grain"), "period", "s.value")
        result = rows if result is None else result.unionByName(rows)
    for name in names:
        if METRICS[name].formula is not None:
            rows = metric(marts, name)
            result = rows if result is None else result.unionByName(rows)
    return result


def allowed_metrics(scopes: Sequence[str], beyond_served: bool = False) -> list[str]:
    """Metrics that one of ``scopes`` may read: its own domain, or all for two of them.

    Only the served series have a scope; all others are refused unless ``beyond_served`` opens them by domain.
    """
    everything = {"executive", "admin"} & set(scopes)
    return [m.name for m in METRICS.values()
            if (beyond_served or m.name in SERVED) and (everything or m.domain in scopes)]


def visible_metrics(spark: SparkSession, scopes: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(m,) for m in allowed_metrics(scopes)], "metric string")


def scope_filter(rows: DataFrame, scopes: Sequence[str]) -> DataFrame:
    """Metric rows that one of the caller's scopes may see.

    Ask ``metric_query`` only for ``allowed_metrics`` where the caller is known up front:
    then the other series are never computed.
    """
    return rows.filter(F.col("metric").isin(allowed_metrics(scopes)))


def metric_metadata(rows: DataFrame, requested_by: str, generated_at: str) -> DataFrame:
    """Version, time, requester, and a currency where the metric is money."""
    money = [m.name for m in METRICS.values() if m.unit == "USD"]
    return rows.withColumns({
        "definition_version": F.lit(VERSION), "generated_at": instant(generated_at),
        "requested_by": F.lit(requested_by),
        "currency": F.when(F.col("metric").isin(money), "USD")})
