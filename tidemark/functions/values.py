"""Money, ratios, keys and text fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
_TENS_OF_MILLIONS = 10_000_000


def cents_to_dollars(cents: Column) -> Column:
    """Integer cents as dollars; exact, because only the scale moves."""
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero or null."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.nullif(bottom, F.lit(0.0))


def percent_of(amount: Column, percent: Column) -> Column:
    """``amount * percent / 100`` without a lossy decimal division."""
    return amount * percent * F.lit("0.01").cast("decimal(3,2)")


def annual_cents(amount_usd: Column, interval: Column) -> Column:
    """Cents per year of a plan: 12 x monthly, 1 x yearly, null for anything else.

    Whole cents per year add up exactly, a twelfth of a yearly price does not.
    """
    cents = (amount_usd * 100).cast("bigint")
    return F.when(interval == "month", cents * 12).when(interval == "year", cents)


def monthly_usd(cents_per_year: Column) -> Column:
    """Monthly dollars out of cents per year, rounded once, half up."""
    return (cents_per_year.cast("decimal(20,0)") / F.lit(1200).cast("decimal(4,0)")).cast(MONEY)


def yearly_usd(cents_per_year: Column) -> Column:
    return cents_to_dollars(cents_per_year)


def attributed_revenue_proxy(spend: Column, multiple: int = 3) -> Column:
    """Placeholder for attributed revenue: a fixed multiple of the spend, 0 for null."""
    return F.coalesce(spend * F.lit(multiple), F.lit(0)).cast(MONEY)


def money_parts(amount: Column, name: str) -> dict[str, Column]:
    """``amount`` of type ``MONEY`` as two whole numbers: tens of millions, and the cents that are left.

    Both are below a billion, so bigints hold their sums over nine billion rows.  For sums over very many rows, where
    adding decimals of 28 digits takes most of the time; ``sum_of_money_parts`` puts the sums together.
    """
    amount = amount.cast(MONEY)
    rest = amount % F.lit(_TENS_OF_MILLIONS)
    return {f"{name}_tens_of_millions": ((amount - rest) / F.lit(_TENS_OF_MILLIONS)).cast("bigint"),
            f"{name}_cents": (rest * F.lit(100)).cast("bigint")}


def sum_of_money_parts(name: str) -> Column:
    """Aggregate: ``sum`` of the amounts behind the columns that ``money_parts`` named, exact, with its type."""
    high = F.sum(f"{name}_tens_of_millions").cast("decimal(19,0)") * F.lit(_TENS_OF_MILLIONS).cast("decimal(8,0)")
    low = F.sum(f"{name}_cents").cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")
    return (high + low).cast("decimal(28,2)")


def surrogate_key(columns: Sequence[Column | str], null_text: str = "_null_") -> Column:
    """MD5 over the columns as text; a null differs from an empty string."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_text))
             for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def json_field(document: Column, path: str, kind: str = "string") -> Column:
    return F.get_json_object(document, path).cast(kind)


def url_parameter(url: Column, name: str) -> Column:
    """One query parameter of a URL; null when absent or when the URL is malformed."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def normal_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def email_domain(email: Column) -> Column:
    cleaned = normal_email(email)
    return F.when(cleaned.contains("@"), F.substring_index(cleaned, "@", -1))
