"""KPI building blocks, all as Column expressions on exact decimals.

Ratios never touch DOUBLE: counts are cast to DECIMAL, divided at 15+ digits
and rounded once.  A zero denominator gives NULL unless ``empty`` names the
value to show instead; every caller states its policy.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickstrata.schemas import MONEY, PERCENT, RATE

# Event type -> name of its count.
COUNT_NAMES = {
    "impression": "impressions",
    "click": "clicks",
    "install": "installs",
    "conversion": "conversions",
    "reward": "rewards",
}
COUNTS = tuple(COUNT_NAMES.values())

_COUNT = "decimal(20,0)"
_CENTS = "decimal(20,2)"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _or_empty(value: Column, empty: int | None) -> Column:
    return value if empty is None else F.coalesce(value, F.lit(empty).cast(RATE))


def count_of(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def funnel_counts(*event_types: str) -> list[Column]:
    """One conditional count per event type, all five unless some are named."""
    wanted = event_types or tuple(COUNT_NAMES)
    return [count_of(kind).alias(COUNT_NAMES[kind]) for kind in wanted]


def total(name: str) -> Column:
    """Sum of a money column; an empty group is 0, not NULL."""
    return F.coalesce(F.sum(name), F.lit(0)).cast(MONEY).alias(name)


def signed_counts(sign: str) -> list[Column]:
    """All five event counts, each event counted by its sign."""
    return [
        F.sum(F.when(F.col("event_type") == kind, F.col(sign)).otherwise(0)).alias(name)
        for kind, name in COUNT_NAMES.items()
    ]


def signed_total(name: str, sign: str) -> Column:
    """Sum of a money column over rows that are added (1) or taken off (-1)."""
    amount = F.when(F.col(sign) < 0, -F.col(name)).otherwise(F.col(name))
    return F.coalesce(F.sum(amount), F.lit(0)).cast(MONEY).alias(name)


def sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def quotient(numerator: str | Column, denominator: str | Column) -> Column:
    """Unrounded count ratio, NULL on a zero denominator."""
    bottom = _col(denominator).cast(_COUNT)
    return _col(numerator).cast(_COUNT) / F.nullif(bottom, F.lit(0).cast(_COUNT))


def money_quotient(numerator: str | Column, denominator: str | Column) -> Column:
    """Unrounded money ratio (return on ad spend), NULL on a zero denominator."""
    bottom = _col(denominator).cast(_CENTS)
    return _col(numerator).cast(_CENTS) / F.nullif(bottom, F.lit(0).cast(_CENTS))


def rate(
    numerator: str | Column, denominator: str | Column, empty: int | None = None
) -> Column:
    """Count ratio rounded half-up to 4 decimals."""
    return _or_empty(F.round(quotient(numerator, denominator), 4).cast(RATE), empty)


def ctr(empty: int | None = None) -> Column:
    return rate("clicks", "impressions", empty).alias("ctr")


def install_rate(empty: int | None = None) -> Column:
    return rate("installs", "clicks", empty).alias("install_rate")


def conversion_rate(empty: int | None = None) -> Column:
    return rate("conversions", "installs", empty).alias("conversion_rate")


def funnel_rates(empty: int | None = None) -> list[Column]:
    return [ctr(empty), install_rate(empty), conversion_rate(empty)]


def impression_rate(empty: int | None = None) -> Column:
    return rate("impressions", "ad_requests", empty).alias("impression_rate")


def install_spend(bid: str = "bid_cpi") -> Column:
    """Cost-per-install spend of a group that has one bid."""
    return (F.col("installs").cast(_COUNT) * F.col(bid)).cast(MONEY)


def profit(
    spend: str = "spend", revenue: str = "revenue", reward_cost: str = "reward_cost"
) -> Column:
    return (F.col(revenue) - F.col(spend) - F.col(reward_cost)).cast(MONEY)


def ecpm(revenue: str = "revenue", empty: int | None = None) -> Column:
    """Revenue per thousand impressions, multiplied first so it rounds once."""
    per_mille = F.col(revenue).cast(_CENTS) * F.lit(1000).cast("decimal(4,0)")
    value = F.round(
        per_mille / F.nullif(F.col("impressions").cast(_COUNT), F.lit(0).cast(_COUNT)),
        2,
    ).cast(MONEY)
    return _or_empty(value, empty).cast(MONEY).alias("ecpm")


def lift_percent(test: Column, baseline: Column) -> Column:
    """Relative change in percent, NULL when the baseline is 0."""
    change = (test - baseline) * F.lit(100).cast("decimal(3,0)")
    return F.round(change / F.nullif(baseline, F.lit(0).cast(RATE)), 2).cast(PERCENT)


def delta(test: Column, baseline: Column) -> Column:
    return (test - baseline).cast(MONEY)
