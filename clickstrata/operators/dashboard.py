"""Datasets behind the dashboard's tiles, tables and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.functions import kpi
from clickstrata.functions.text import message
from clickstrata.operators.experiments import experiment_uplift
from clickstrata.operators.reporting import (
    _APP_TRAITS,
    _CAMPAIGN_SUMS,
    _FUNNEL,
    CAMPAIGN_TRAITS,
    _apps_with_publisher,
    campaign_totals,
)


def overview_totals(daily_campaigns: DataFrame) -> DataFrame:
    """One row of totals and rates over the whole daily campaign table."""
    return daily_campaigns.agg(*kpi.sums(*_CAMPAIGN_SUMS)).select(
        *_FUNNEL, *kpi.funnel_rates(empty=0), "spend", "revenue", "profit"
    )


def overview_tiles(totals: DataFrame) -> DataFrame:
    """The overview row as display text; an empty period shows zeros."""

    def whole(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("string").alias(name)

    def money(name: str) -> Column:
        zero = F.lit(0).cast("decimal(30,2)")
        amount = F.coalesce(F.col(name).cast("decimal(30,2)"), zero)
        return amount.cast("string").alias(name)

    def percent(name: str) -> Column:
        share = F.round(F.col(name) * F.lit(100).cast("decimal(3,0)"), 2)
        return F.concat(share.cast("decimal(20,2)").cast("string"), F.lit("%")).alias(
            name
        )

    return totals.select(
        *[whole(name) for name in ("impressions", "clicks", "installs")],
        *[money(name) for name in ("revenue", "profit")],
        *[percent(name) for name in ("ctr", "install_rate", "conversion_rate")],
    )


def campaign_performance(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return (
        campaign_totals(daily, campaigns, *CAMPAIGN_TRAITS)
        .select(
            "campaign_id",
            *CAMPAIGN_TRAITS,
            *_FUNNEL,
            *kpi.funnel_rates(empty=0),
            "spend",
            "revenue",
            "profit",
            kpi.ecpm(empty=0),
        )
        .orderBy(F.desc("profit"), "campaign_id")
    )


def app_performance(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return (
        _apps_with_publisher(daily, apps, publishers)
        .select(
            *_APP_TRAITS,
            *_FUNNEL,
            kpi.ctr(empty=0),
            kpi.install_rate(empty=0),
            "revenue",
            "reward_cost",
        )
        .orderBy(F.desc("revenue"), "app_id")
    )


def chart_campaign_money(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return campaign_performance(daily, campaigns).select(
        "campaign_name", "revenue", "spend", "profit"
    )


def chart_app_money(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return app_performance(daily, apps, publishers).select(
        "app_name", "revenue", "reward_cost"
    )


def experiment_view(results: DataFrame) -> DataFrame:
    return results.select(
        "variant",
        "algorithm_name",
        "ad_requests",
        *_FUNNEL,
        "ctr",
        "install_rate",
        "conversion_rate",
        "spend",
        "revenue",
        "reward_cost",
        "profit",
        "ecpm",
    ).orderBy("variant", "algorithm_name")


def experiment_uplift_view(results: DataFrame) -> DataFrame:
    """Lifts and deltas without their base columns, plus one summary sentence."""
    summary = message(
        "Variant B improved CTR by ",
        F.col("ctr_lift_percent"),
        "%, install rate by ",
        F.col("install_rate_lift_percent"),
        "%, conversion rate by ",
        F.col("conversion_rate_lift_percent"),
        "%, with a profit delta of ",
        F.col("profit_delta"),
        ".",
    )
    return experiment_uplift(results).select(
        "baseline_variant",
        "test_variant",
        "baseline_algorithm",
        "test_algorithm",
        "ctr_lift_percent",
        "install_rate_lift_percent",
        "conversion_rate_lift_percent",
        "revenue_delta",
        "spend_delta",
        "profit_delta",
        "ecpm_delta",
        summary.alias("summary"),
    )
