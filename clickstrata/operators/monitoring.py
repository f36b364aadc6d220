"""Performance alerts on the daily campaign table and the A/B results.

The four whole-period rules share one rollup per campaign.  Conditions use
unrounded ratios, messages rounded ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.functions import kpi
from clickstrata.functions.rules import Rule, emit
from clickstrata.operators.alerting import (
    EXPERIMENT_MONITORING,
    GENERATED_MONITORING,
    AlertKind,
    open_alerts,
    union_alerts,
)
from clickstrata.operators.experiments import arms_side_by_side, change, lift
from clickstrata.operators.reporting import campaign_totals
from clickstrata.schemas import MONEY, PERCENT, RATE


@dataclass(frozen=True)
class Thresholds:
    """The defaults every rule starts from."""

    profit_floor: Decimal = Decimal("-150")
    spend_floor: Decimal = Decimal("100")
    roas_floor: Decimal = Decimal("0.50")
    min_impressions: int = 100
    ctr_floor: Decimal = Decimal("0.22")
    install_rate_floor: Decimal = Decimal("0.32")
    min_daily_impressions: int = 20
    ctr_drop: Decimal = Decimal("0.30")
    profit_gain: Decimal = Decimal("50")


DEFAULTS = Thresholds()


def _performance(rule_id: str, severity: str) -> AlertKind:
    return AlertKind(rule_id, GENERATED_MONITORING, "performance", severity, "campaign")


def _campaign_text(*rest: str | Column) -> list[str | Column]:
    return [
        "[Generated Monitoring] Campaign ",
        F.col("campaign_id"),
        " - ",
        F.col("campaign_name"),
        *rest,
    ]


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def _ctr() -> Column:
    return kpi.quotient("clicks", "impressions")


def _install_rate() -> Column:
    return kpi.quotient("installs", "clicks")


def _roas() -> Column:
    return kpi.money_quotient("revenue", "spend")


def _negative_profit(limits: Thresholds) -> Rule:
    return _performance("mon_negative_profit", "high").rule(
        F.col("profit") < F.lit(limits.profit_floor),
        F.col("campaign_id"),
        *_campaign_text(
            " has very negative total profit: ",
            _money("profit"),
            ". Revenue: ",
            _money("revenue"),
            ", Spend: ",
            _money("spend"),
            ".",
        ),
    )


def _high_spend_low_revenue(limits: Thresholds) -> Rule:
    return _performance("mon_high_spend_low_revenue", "medium").rule(
        (F.col("spend") > F.lit(limits.spend_floor))
        & (_roas() < F.lit(limits.roas_floor)),
        F.col("campaign_id"),
        *_campaign_text(
            " has high spend compared to revenue. Spend: ",
            _money("spend"),
            ", Revenue: ",
            _money("revenue"),
            ", ROAS: ",
            F.round(_roas(), 4).cast(RATE),
            ".",
        ),
    )


def _low_ctr(limits: Thresholds) -> Rule:
    return _performance("mon_low_ctr", "medium").rule(
        (F.col("impressions") >= limits.min_impressions)
        & (_ctr() < F.lit(limits.ctr_floor)),
        F.col("campaign_id"),
        *_campaign_text(
            " has low CTR: ",
            kpi.ctr(),
            ". Impressions: ",
            F.col("impressions"),
            ", Clicks: ",
            F.col("clicks"),
            ".",
        ),
    )


def _weak_install_rate(limits: Thresholds) -> Rule:
    return _performance("mon_weak_install_rate", "medium").rule(
        (F.col("impressions") >= limits.min_impressions)
        & (_ctr() >= F.lit(limits.ctr_floor))
        & (_install_rate() < F.lit(limits.install_rate_floor)),
        F.col("campaign_id"),
        *_campaign_text(
            " has acceptable CTR but weak install rate. CTR: ",
            kpi.ctr(),
            ", Install rate: ",
            kpi.install_rate(),
            ".",
        ),
    )


_CAMPAIGN_RULES = {
    "mon_negative_profit": _negative_profit,
    "mon_high_spend_low_revenue": _high_spend_low_revenue,
    "mon_low_ctr": _low_ctr,
    "mon_weak_install_rate": _weak_install_rate,
}


def campaign_alerts(
    daily: DataFrame,
    campaigns: DataFrame,
    *rule_ids: str,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """The named whole-period rules (all four by default) from one rollup."""
    wanted = rule_ids or tuple(_CAMPAIGN_RULES)
    return emit(
        campaign_totals(daily, campaigns, "campaign_name"),
        [_CAMPAIGN_RULES[rule_id](limits) for rule_id in wanted],
    )


def daily_ctr_drop(
    daily: DataFrame, campaigns: DataFrame, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """Campaign days whose CTR fell hard against the previous active day.

    The window sees one row per campaign and day.  The relative drop is taken
    from the four counts directly, kept/previous = (c * pi) / (i * pc), so a
    drop of exactly the threshold is not lost to a rounded quotient.
    """
    days = (
        daily.groupBy("metric_date", "campaign_id")
        .agg(*kpi.sums("impressions", "clicks"))
        .join(campaigns.select("campaign_id", "campaign_name"), "campaign_id")
    )
    before = Window.partitionBy("campaign_id").orderBy("metric_date")
    compared = days.withColumns(
        {
            "previous_impressions": F.lag("impressions").over(before),
            "previous_clicks": F.lag("clicks").over(before),
        }
    )

    def product(left: str, right: str) -> Column:
        wide = "decimal(19,0)"
        return (F.col(left).cast(wide) * F.col(right).cast(wide)).cast("decimal(24,0)")

    was = product("impressions", "previous_clicks")
    lost = (was - product("clicks", "previous_impressions")).cast("decimal(24,0)")
    # The guard keeps the quotients from being built for a zero base.
    base = F.nullif(was, F.lit(0).cast("decimal(24,0)"))
    percent = F.round(lost * F.lit(100).cast("decimal(3,0)") / base, 2).cast(PERCENT)
    rule = _performance("mon_daily_ctr_drop", "high").rule(
        (F.col("previous_impressions") > 0)
        & (F.col("previous_clicks") > 0)
        & (F.col("impressions") >= limits.min_daily_impressions)
        & (lost >= was * F.lit(limits.ctr_drop)),
        F.col("campaign_id"),
        *_campaign_text(
            " CTR dropped by ",
            percent,
            "% on ",
            F.col("metric_date"),
            ". Previous CTR: ",
            kpi.rate("previous_clicks", "previous_impressions"),
            ", Current CTR: ",
            kpi.ctr(),
            ".",
        ),
    )
    return emit(compared, [rule])


def experiment_tradeoff(
    results: DataFrame, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """B engages better than A but hardly earns more."""
    sides = arms_side_by_side(
        results, "variant", "ctr", "install_rate", "conversion_rate", "profit"
    )
    kind = AlertKind(
        "mon_experiment_tradeoff",
        EXPERIMENT_MONITORING,
        "experiment",
        "medium",
        "experiment",
    )
    rule = kind.rule(
        (F.col("b_ctr") > F.col("a_ctr"))
        & (F.col("b_install_rate") > F.col("a_install_rate"))
        & (change("profit") < F.lit(limits.profit_gain)),
        F.col("b_variant"),
        "[Experiment Monitoring] Variant B improved CTR by ",
        lift("ctr"),
        "%, install rate by ",
        lift("install_rate"),
        "%, and conversion rate by ",
        lift("conversion_rate"),
        "%, but profit delta is only ",
        change("profit"),
        ". Review whether the higher spend is justified.",
    )
    return emit(sides, [rule])


def monitoring_alerts(
    daily: DataFrame,
    campaigns: DataFrame,
    results: DataFrame,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """All six rules as one bag of open alerts."""
    return open_alerts(
        union_alerts(
            campaign_alerts(daily, campaigns, limits=limits),
            daily_ctr_drop(daily, campaigns, limits),
            experiment_tradeoff(results, limits),
        )
    )
