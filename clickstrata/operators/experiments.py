"""A/B comparison of delivery algorithms.

Events are summed per ad request before they meet the requests.  Both sides of
that outer join are then keyed by ``tracking_id`` (the aggregate already
produced that partitioning), one hot request cannot unbalance it, and every
request appears exactly once, so counting requests needs no DISTINCT.  The
experiment and campaign dimensions join last, on a few summed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.functions import kpi
from clickstrata.operators.reporting import in_scope

_RATES = ("ctr", "install_rate", "conversion_rate")
_MONEY = ("revenue", "spend", "profit", "ecpm")


def experiment_assignment(
    requests: DataFrame, experiments: DataFrame, prefix: str | None = None
) -> DataFrame:
    """Requests per experiment arm."""
    return (
        in_scope(requests, prefix)
        .groupBy("experiment_id")
        .agg(F.count(F.lit(1)).alias("ad_requests"))
        .join(experiments, "experiment_id")
        .select(
            "experiment_id",
            "experiment_name",
            "variant",
            "algorithm_name",
            "ad_requests",
        )
        .orderBy("variant", "experiment_id")
    )


def _arm_totals(
    requests: DataFrame,
    events: DataFrame,
    experiments: DataFrame,
    campaigns: DataFrame,
    keys: tuple[str, ...],
    prefix: str | None,
    by_day: bool = False,
) -> DataFrame:
    """Counts and money of all requests of each group, served or not."""
    per_request = (
        in_scope(events.filter(F.col("tracking_id").isNotNull()), prefix)
        .groupBy("tracking_id")
        .agg(
            *kpi.funnel_counts(),
            *kpi.sums("revenue", "reward_cost"),
        )
    )
    asked = in_scope(requests, prefix)
    day: list[Column] = []
    if by_day:
        day = [F.to_date("request_time").alias("request_date")]
    asked = asked.select("tracking_id", "experiment_id", "campaign_id", *day)
    day_key = ["request_date"] if by_day else []

    summed = ("revenue", "reward_cost")
    per_campaign = (
        asked.join(per_request, "tracking_id", "left")
        .groupBy("experiment_id", "campaign_id", *day_key)
        .agg(
            F.count(F.lit(1)).alias("ad_requests"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kpi.COUNTS],
            *[kpi.total(c) for c in summed],
        )
    )
    return (
        per_campaign.join(campaigns.select("campaign_id", "bid_cpi"), "campaign_id")
        .withColumn("spend", kpi.install_spend())
        .join(experiments, "experiment_id")
        .groupBy(*keys)
        .agg(
            *kpi.sums("ad_requests", *kpi.COUNTS),
            *[kpi.total(c) for c in ("spend", *summed)],
        )
        .withColumn("profit", kpi.profit())
    )


def experiment_kpi(
    requests: DataFrame,
    events: DataFrame,
    experiments: DataFrame,
    campaigns: DataFrame,
    prefix: str | None = None,
) -> DataFrame:
    """All KPIs per variant and algorithm."""
    keys = ("variant", "algorithm_name")
    totals = _arm_totals(requests, events, experiments, campaigns, keys, prefix)
    return _with_kpis(totals, keys).orderBy(*keys)


def experiment_results(
    requests: DataFrame,
    events: DataFrame,
    experiments: DataFrame,
    campaigns: DataFrame,
    prefix: str | None = None,
) -> DataFrame:
    """The stored comparison table, keyed by experiment as well."""
    keys = ("experiment_name", "variant", "algorithm_name")
    totals = _arm_totals(requests, events, experiments, campaigns, keys, prefix)
    return _with_kpis(totals, keys)


def _with_kpis(totals: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return totals.select(
        *keys,
        "ad_requests",
        *kpi.COUNTS,
        kpi.impression_rate(empty=0),
        *kpi.funnel_rates(empty=0),
        "spend",
        "revenue",
        "reward_cost",
        "profit",
        kpi.ecpm(empty=0),
    )


def experiment_daily_trend(
    requests: DataFrame,
    events: DataFrame,
    experiments: DataFrame,
    campaigns: DataFrame,
    prefix: str | None = None,
) -> DataFrame:
    """Per day of the request (not of the event) and variant."""
    keys = ("request_date", "variant", "algorithm_name")
    return (
        _arm_totals(
            requests, events, experiments, campaigns, keys, prefix, by_day=True
        )
        .select(
            *keys,
            "ad_requests",
            "impressions",
            "clicks",
            "installs",
            "conversions",
            kpi.ctr(empty=0),
            kpi.install_rate(empty=0),
            "revenue",
            "spend",
            "profit",
        )
        .orderBy(*keys)
    )


def arms_side_by_side(results: DataFrame, *columns: str) -> DataFrame:
    """Variant A's and B's rows of each experiment joined as a_* and b_*."""

    def arm(variant: str) -> DataFrame:
        side = variant.lower()
        return results.filter(F.col("variant") == variant).select(
            "experiment_name", *[F.col(c).alias(f"{side}_{c}") for c in columns]
        )

    return arm("A").join(arm("B"), "experiment_name")


def lift(name: str) -> Column:
    return kpi.lift_percent(F.col(f"b_{name}"), F.col(f"a_{name}"))


def change(name: str) -> Column:
    return kpi.delta(F.col(f"b_{name}"), F.col(f"a_{name}"))


def experiment_uplift(results: DataFrame) -> DataFrame:
    """B against A: relative lifts of the stored rates, deltas of the money."""
    sides = arms_side_by_side(
        results, "variant", "algorithm_name", "ad_requests", *_RATES, *_MONEY
    )
    columns: list[Column] = [
        F.col("a_variant").alias("baseline_variant"),
        F.col("b_variant").alias("test_variant"),
        F.col("a_algorithm_name").alias("baseline_algorithm"),
        F.col("b_algorithm_name").alias("test_algorithm"),
        F.col("a_ad_requests"),
        F.col("b_ad_requests"),
    ]
    for name in _RATES:
        columns += [
            F.col(f"a_{name}"),
            F.col(f"b_{name}"),
            lift(name).alias(f"{name}_lift_percent"),
        ]
    for name in _MONEY:
        columns += [
            F.col(f"a_{name}"),
            F.col(f"b_{name}"),
            change(name).alias(f"{name}_delta"),
        ]
    return sides.select(*columns)
