"""Funnel, daily metrics and the rollups over them.

Facts are always reduced on their own key first and meet dimensions after:
the join then handles one row per key instead of one per event, so a campaign
holding a third of all events costs nothing extra, and no dimension has to fit
a broadcast for the plan to work.  Dimension keys are unique (audited), which
is what makes the two orders equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.functions import kpi

CAMPAIGN_TRAITS = (
    "campaign_name",
    "target_country",
    "target_platform",
    "target_category",
)


def in_scope(rows: DataFrame, prefix: str | None) -> DataFrame:
    """Rows whose tracking id starts with a literal prefix; None means all."""
    if prefix is None:
        return rows
    return rows.filter(F.col("tracking_id").startswith(prefix))


# --- straight from events ---------------------------------------------------


def funnel_by_tracking(events: DataFrame, prefix: str | None = None) -> DataFrame:
    """Five event counts and both money sums per ad request."""
    return (
        in_scope(events, prefix)
        .groupBy("tracking_id")
        .agg(
            *kpi.funnel_counts(),
            F.sum("revenue").alias("revenue"),
            F.sum("reward_cost").alias("reward_cost"),
        )
        .orderBy("tracking_id")
    )


def volume(rows: DataFrame, name: str, prefix: str | None = None) -> DataFrame:
    return in_scope(rows, prefix).agg(F.count(F.lit(1)).alias(name))


def event_type_distribution(events: DataFrame, prefix: str | None = None) -> DataFrame:
    return (
        in_scope(events, prefix)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def _campaign_money(
    events: DataFrame, campaigns: DataFrame, keys: list[str | Column], *traits: str
) -> DataFrame:
    """Counts and money per group that has one campaign, priced by its bid."""
    sums = events.groupBy(*keys).agg(
        *kpi.funnel_counts(), kpi.total("revenue"), kpi.total("reward_cost")
    )
    return _priced(sums, campaigns, *traits)


def _priced(sums: DataFrame, campaigns: DataFrame, *traits: str) -> DataFrame:
    priced = sums.join(campaigns.select("campaign_id", *traits, "bid_cpi"), "campaign_id")
    return priced.withColumn("spend", kpi.install_spend()).withColumn(
        "profit", kpi.profit()
    )


def campaign_kpi(
    events: DataFrame,
    campaigns: DataFrame,
    prefix: str | None = None,
    empty_ecpm: int | None = 0,
) -> DataFrame:
    """All KPIs per campaign; rates without a base are NULL."""
    return (
        _campaign_money(
            in_scope(events, prefix), campaigns, ["campaign_id"], *CAMPAIGN_TRAITS
        )
        .select(
            "campaign_id",
            *CAMPAIGN_TRAITS,
            "bid_cpi",
            *kpi.COUNTS,
            *kpi.funnel_rates(),
            "spend",
            "revenue",
            "reward_cost",
            "profit",
            kpi.ecpm(empty=empty_ecpm),
        )
        .orderBy(F.desc("profit"), "campaign_id")
    )


def _metric_date() -> Column:
    return F.to_date("event_time").alias("metric_date")


def daily_campaign_metrics(
    events: DataFrame, campaigns: DataFrame, prefix: str | None = None
) -> DataFrame:
    """The stored per-day campaign table; rates without a base are 0."""
    return _daily_campaign_columns(
        _campaign_money(
            in_scope(events, prefix), campaigns, [_metric_date(), "campaign_id"]
        )
    )


def _daily_campaign_columns(money: DataFrame) -> DataFrame:
    return money.select(
        "metric_date",
        "campaign_id",
        *kpi.COUNTS,
        *kpi.funnel_rates(empty=0),
        "spend",
        "revenue",
        "profit",
        kpi.ecpm(empty=0),
    )


def daily_app_metrics(events: DataFrame, prefix: str | None = None) -> DataFrame:
    """The stored per-day app table."""
    return (
        in_scope(events, prefix)
        .groupBy(_metric_date(), "app_id")
        .agg(
            *kpi.funnel_counts("impression", "click", "install", "conversion"),
            kpi.total("revenue"),
            kpi.total("reward_cost"),
        )
    )


# --- daily tables kept by differences ---------------------------------------
#
# What a daily table is computed from adds up: counts and money per day and key.
# A batch adds a row of differences per day and key that it changes, with events
# that are no longer clean taken off, and a day is the sum of its rows.  Rates,
# spend and profit do not add up; they are computed from the sums.


def daily_sums(changes: DataFrame, key: str, prefix: str | None = None) -> DataFrame:
    """Events of ``sign`` 1 added and of ``sign`` -1 taken off, per day and key."""
    return (
        in_scope(changes, prefix)
        .groupBy(_metric_date(), key)
        .agg(
            F.sum("sign").alias("events"),
            *kpi.signed_counts("sign"),
            kpi.signed_total("revenue", "sign"),
            kpi.signed_total("reward_cost", "sign"),
        )
    )


def merged_sums(parts: DataFrame, key: str) -> DataFrame:
    """One row per day and key; a key of which no event is left has none."""
    return (
        parts.groupBy("metric_date", key)
        .agg(
            *kpi.sums("events", *kpi.COUNTS),
            kpi.total("revenue"),
            kpi.total("reward_cost"),
        )
        .filter(F.col("events") > 0)
    )


def daily_campaign_of_sums(parts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """``daily_campaign_metrics`` of the events that the sums stand for."""
    return _daily_campaign_columns(
        _priced(merged_sums(parts, "campaign_id"), campaigns)
    )


def daily_app_of_sums(parts: DataFrame) -> DataFrame:
    """``daily_app_metrics`` of the events that the sums stand for."""
    return merged_sums(parts, "app_id").drop("events", "rewards")


# --- listings of the daily tables ------------------------------------------


def _daily_campaign_rows(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    named = daily.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id")
    rest = [c for c in daily.columns if c not in ("metric_date", "campaign_id")]
    return named.select("metric_date", "campaign_id", "campaign_name", *rest)


def daily_campaign_by_profit(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return _daily_campaign_rows(daily, campaigns).orderBy(
        F.desc("profit"), "metric_date", "campaign_id"
    )


def daily_campaign_overview(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return _daily_campaign_rows(daily, campaigns).orderBy(
        "metric_date", F.desc("profit"), "campaign_id"
    )


def daily_app_overview(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return (
        daily.join(
            apps.select("app_id", "app_name", "category", "platform", "publisher_id"),
            "app_id",
        )
        .join(publishers.select("publisher_id", "publisher_name"), "publisher_id")
        .select(
            "metric_date",
            "app_id",
            "app_name",
            "category",
            "platform",
            "publisher_name",
            "impressions",
            "clicks",
            "installs",
            "conversions",
            "revenue",
            "reward_cost",
        )
        .orderBy("metric_date", F.desc("revenue"), "app_id")
    )


# --- rollups of the daily tables -------------------------------------------

_CAMPAIGN_SUMS = (
    "impressions",
    "clicks",
    "installs",
    "conversions",
    "spend",
    "revenue",
    "profit",
)
_APP_SUMS = (
    "impressions",
    "clicks",
    "installs",
    "conversions",
    "revenue",
    "reward_cost",
)
_FUNNEL = ("impressions", "clicks", "installs", "conversions")


def campaign_totals(daily: DataFrame, campaigns: DataFrame, *traits: str) -> DataFrame:
    """Daily campaign rows summed per known campaign, with chosen traits."""
    totals = daily.groupBy("campaign_id").agg(*kpi.sums(*_CAMPAIGN_SUMS))
    return totals.join(campaigns.select("campaign_id", *traits), "campaign_id")


def app_totals(daily: DataFrame, apps: DataFrame, *traits: str) -> DataFrame:
    """Daily app rows summed per known app, with chosen traits."""
    totals = daily.groupBy("app_id").agg(*kpi.sums(*_APP_SUMS))
    return totals.join(apps.select("app_id", *traits), "app_id")


def _totals(*names: str) -> list[Column]:
    return [F.col(name).alias(f"total_{name}") for name in names]


def campaigns_best(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return (
        campaign_totals(daily, campaigns, *CAMPAIGN_TRAITS)
        .select(
            "campaign_id",
            *CAMPAIGN_TRAITS,
            *_FUNNEL,
            *kpi.funnel_rates(),
            *_totals("spend", "revenue", "profit"),
            kpi.ecpm(),
        )
        .orderBy(F.desc("total_profit"), "campaign_id")
    )


def campaigns_worst(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return (
        campaign_totals(daily, campaigns, *CAMPAIGN_TRAITS)
        .select(
            "campaign_id",
            *CAMPAIGN_TRAITS,
            *_FUNNEL,
            kpi.ctr(),
            kpi.install_rate(),
            *_totals("spend", "revenue", "profit"),
        )
        .orderBy("total_profit", "campaign_id")
    )


def apps_by_revenue(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return (
        _apps_with_publisher(daily, apps, publishers)
        .select(
            *_APP_TRAITS,
            *_FUNNEL,
            kpi.ctr(),
            kpi.install_rate(),
            *_totals("revenue", "reward_cost"),
        )
        .orderBy(F.desc("total_revenue"), "app_id")
    )


_APP_TRAITS = ("app_id", "app_name", "publisher_name", "category", "platform")


def _apps_with_publisher(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return app_totals(
        daily, apps, "app_name", "category", "platform", "publisher_id"
    ).join(publishers.select("publisher_id", "publisher_name"), "publisher_id")


def publisher_performance(
    daily: DataFrame, apps: DataFrame, publishers: DataFrame
) -> DataFrame:
    return (
        app_totals(daily, apps, "publisher_id")
        .groupBy("publisher_id")
        .agg(*kpi.sums(*_APP_SUMS))
        .join(
            publishers.select(
                "publisher_id",
                "publisher_name",
                F.col("country").alias("publisher_country"),
            ),
            "publisher_id",
        )
        .select(
            "publisher_id",
            "publisher_name",
            "publisher_country",
            *_FUNNEL,
            kpi.ctr(),
            kpi.install_rate(),
            *_totals("revenue", "reward_cost"),
        )
        .orderBy(F.desc("total_revenue"), "publisher_id")
    )


def country_platform_performance(daily: DataFrame, campaigns: DataFrame) -> DataFrame:
    return (
        campaign_totals(daily, campaigns, "target_country", "target_platform")
        .groupBy("target_country", "target_platform")
        .agg(*kpi.sums(*_CAMPAIGN_SUMS))
        .select(
            "target_country",
            "target_platform",
            *_FUNNEL,
            *kpi.funnel_rates(),
            *_totals("spend", "revenue", "profit"),
        )
        .orderBy(F.desc("total_profit"), "target_country", "target_platform")
    )


def category_performance(daily: DataFrame, apps: DataFrame) -> DataFrame:
    return (
        app_totals(daily, apps, "category")
        .groupBy("category")
        .agg(*kpi.sums(*_APP_SUMS))
        .select(
            "category",
            *_FUNNEL,
            kpi.ctr(),
            kpi.install_rate(),
            *_totals("revenue", "reward_cost"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


# --- health checks of the daily tables -------------------------------------


def null_kpi_rows(daily: DataFrame) -> DataFrame:
    """Daily campaign rows with any NULL rate; 0 in a sound table."""
    gaps = F.lit(False)
    for name in ("ctr", "install_rate", "conversion_rate", "ecpm"):
        gaps = gaps | F.col(name).isNull()
    return daily.agg(F.count_if(gaps).alias("rows_with_null_campaign_kpis"))
