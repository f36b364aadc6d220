"""Every job by name: a function of the derived tables returning a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.operators import (
    alerting,
    audit,
    dashboard,
    experiments,
    inventory,
    maintenance,
    monitoring,
    quality_alerts,
    reporting,
    validation,
)
from clickstrata.plans.jobs import Jobs
from clickstrata.session import tune

# The scope the purge query removes: repeated events, and a range of requests.
PURGE_SCOPE = maintenance.Scope(event_prefix="py_dup_", tracking_prefix="trk_py_1")


def _funnel_and_reporting() -> dict[str, Callable[[Jobs], DataFrame]]:
    r = reporting
    return {
        "funnel_by_tracking": lambda j: r.funnel_by_tracking(j.events_raw, j.scope),
        "campaign_kpi": lambda j: r.campaign_kpi(j.events_raw, j.campaigns, j.scope),
        "campaign_kpi_nullable_ecpm": lambda j: r.campaign_kpi(
            j.events_raw, j.campaigns, j.scope, empty_ecpm=None
        ),
        "daily_campaign_metrics_raw": lambda j: r.daily_campaign_metrics(
            j.events_raw, j.campaigns, j.scope
        ),
        "daily_campaign_metrics": lambda j: j.daily_campaign,
        "daily_app_metrics_raw": lambda j: r.daily_app_metrics(j.events_raw, j.scope),
        "daily_app_metrics": lambda j: j.daily_app,
        "daily_app_overview": lambda j: r.daily_app_overview(
            j.daily_app, j.apps, j.publishers
        ),
        "daily_campaign_by_profit": lambda j: r.daily_campaign_by_profit(
            j.daily_campaign, j.campaigns
        ),
        "daily_campaign_overview": lambda j: r.daily_campaign_overview(
            j.daily_campaign, j.campaigns
        ),
        "campaigns_best": lambda j: r.campaigns_best(j.daily_campaign, j.campaigns),
        "campaigns_worst": lambda j: r.campaigns_worst(j.daily_campaign, j.campaigns),
        "apps_by_revenue": lambda j: r.apps_by_revenue(
            j.daily_app, j.apps, j.publishers
        ),
        "publisher_performance": lambda j: r.publisher_performance(
            j.daily_app, j.apps, j.publishers
        ),
        "country_platform_performance": lambda j: r.country_platform_performance(
            j.daily_campaign, j.campaigns
        ),
        "category_performance": lambda j: r.category_performance(j.daily_app, j.apps),
        "volume_requests": lambda j: r.volume(
            j.ad_requests, "generated_ad_requests", j.scope
        ),
        "volume_events": lambda j: r.volume(j.events_raw, "generated_events", j.scope),
        "event_type_distribution": lambda j: r.event_type_distribution(
            j.events_raw, j.scope
        ),
    }


def _quality_alerts() -> dict[str, Callable[[Jobs], DataFrame]]:
    q = quality_alerts
    return {
        "dq_missing_or_unknown_tracking": lambda j: q.missing_or_unknown_tracking(
            j.events_raw, j.ad_requests
        ),
        "dq_duplicate_event_id": lambda j: q.duplicate_event_id(j.events_raw),
        "dq_duplicate_installs": lambda j: q.duplicate_installs(j.events_raw),
        "dq_click_without_impression": lambda j: q.click_without_impression(
            j.events_raw
        ),
        "dq_install_without_click": lambda j: q.install_without_click(j.events_raw),
        "dq_targeting_mismatch": lambda j: q.targeting_mismatch(
            j.events_raw, j.campaigns
        ),
        "perf_clicks_without_installs": lambda j: q.clicks_without_installs(
            j.events_raw
        ),
        "dq_alerts_all": lambda j: j.quality_alerts,
        "dq_alerts_listing": lambda j: alerting.alerts_listing(j.quality_alerts),
    }


def _validation() -> dict[str, Callable[[Jobs], DataFrame]]:
    v = validation

    def rule(error_type: str) -> Callable[[Jobs], DataFrame]:
        def run(j: Jobs) -> DataFrame:
            duplicates = j.duplicates if error_type == "duplicate_event_id" else None
            return v.single_rule_errors(
                error_type, j.events_raw, j.ad_requests, duplicates
            )

        return run

    return {
        **{f"val_{error_type}": rule(error_type) for error_type in v.ERROR_TYPES},
        "validation_errors": lambda j: j.validation_errors,
        "events_clean": lambda j: j.events_clean,
        "pipeline_counts": lambda j: v.pipeline_counts(
            j.events_raw, j.ad_requests, j.duplicates
        ),
        "validation_error_summary": lambda j: v.validation_error_summary(
            j.validation_errors
        ),
        "clean_event_distribution": lambda j: v.clean_event_distribution(
            j.events_clean
        ),
        "check_clean_duplicates": lambda j: v.clean_duplicates(j.events_clean),
        "check_clean_orphans": lambda j: v.clean_orphans(
            j.events_clean, j.ad_requests
        ),
        "check_daily_campaign_rows": lambda j: reporting.volume(
            j.daily_campaign, "daily_campaign_metric_rows"
        ),
        "check_daily_app_rows": lambda j: reporting.volume(
            j.daily_app, "daily_app_metric_rows"
        ),
        "check_null_kpis": lambda j: reporting.null_kpi_rows(j.daily_campaign),
    }


def _experiments() -> dict[str, Callable[[Jobs], DataFrame]]:
    e = experiments

    def inputs(j: Jobs) -> tuple:
        return j.ad_requests, j.events_raw, j.experiments, j.campaigns, j.scope

    return {
        "experiment_assignment": lambda j: e.experiment_assignment(
            j.ad_requests, j.experiments, j.scope
        ),
        "experiment_kpi": lambda j: e.experiment_kpi(*inputs(j)),
        "experiment_results": lambda j: j.experiment_results,
        "experiment_uplift": lambda j: e.experiment_uplift(j.experiment_results),
        "experiment_daily_trend": lambda j: e.experiment_daily_trend(*inputs(j)),
    }


def _monitoring() -> dict[str, Callable[[Jobs], DataFrame]]:
    def campaign_rule(rule_id: str) -> Callable[[Jobs], DataFrame]:
        return lambda j: monitoring.campaign_alerts(
            j.daily_campaign, j.campaigns, rule_id
        )

    def refreshed(j: Jobs) -> DataFrame:
        of_monitoring = F.col("rule_group").isin(*alerting.MONITORING_GROUPS)
        return alerting.alerts_listing(j.alerts.filter(of_monitoring))

    return {
        "mon_negative_profit": campaign_rule("mon_negative_profit"),
        "mon_high_spend_low_revenue": campaign_rule("mon_high_spend_low_revenue"),
        "mon_low_ctr": campaign_rule("mon_low_ctr"),
        "mon_weak_install_rate": campaign_rule("mon_weak_install_rate"),
        "mon_daily_ctr_drop": lambda j: monitoring.daily_ctr_drop(
            j.daily_campaign, j.campaigns
        ),
        "mon_experiment_tradeoff": lambda j: monitoring.experiment_tradeoff(
            j.experiment_results
        ),
        "monitoring_alerts": refreshed,
    }


def _dashboard() -> dict[str, Callable[[Jobs], DataFrame]]:
    d = dashboard
    return {
        "overview_totals": lambda j: d.overview_totals(j.daily_campaign),
        "overview_tiles": lambda j: d.overview_tiles(d.overview_totals(j.daily_campaign)),
        "campaign_performance": lambda j: d.campaign_performance(
            j.daily_campaign, j.campaigns
        ),
        "app_performance": lambda j: d.app_performance(
            j.daily_app, j.apps, j.publishers
        ),
        "chart_campaign_money": lambda j: d.chart_campaign_money(
            j.daily_campaign, j.campaigns
        ),
        "chart_app_money": lambda j: d.chart_app_money(
            j.daily_app, j.apps, j.publishers
        ),
        "experiment_view": lambda j: d.experiment_view(j.experiment_results),
        "experiment_uplift_view": lambda j: d.experiment_uplift_view(
            j.experiment_results
        ),
        "alerts_view": lambda j: alerting.alerts_listing(j.alerts),
        "alert_summary": lambda j: alerting.alert_summary(j.alerts),
        "validation_summary_view": lambda j: validation.validation_error_summary(
            j.validation_errors
        ),
        "rejected_events_view": lambda j: validation.rejected_events_view(
            j.validation_errors
        ),
    }


def _upkeep() -> dict[str, Callable[[Jobs], DataFrame]]:
    def audited(j: Jobs) -> DataFrame:
        return audit.constraint_audit(
            {
                "publishers": j.publishers,
                "apps": j.apps,
                "advertisers": j.advertisers,
                "campaigns": j.campaigns,
                "users": j.users,
                "experiments": j.experiments,
                "ad_requests": j.ad_requests,
                "events_raw": j.events_raw,
                "events_clean": j.events_clean,
                "daily_campaign_metrics": j.daily_campaign,
                "daily_app_metrics": j.daily_app,
                "alerts": j.alerts,
                "experiment_results": j.experiment_results,
                "event_validation_errors": j.validation_errors,
            }
        )

    def purge(j: Jobs) -> DataFrame:
        return maintenance.survivor_counts(
            maintenance.FactTables(
                event_validation_errors=j.validation_errors,
                events_clean=j.events_clean,
                events_raw=j.events_raw,
                ad_requests=j.ad_requests,
            ),
            PURGE_SCOPE,
        )

    return {
        "constraint_audit": audited,
        "scoped_purge": purge,
        "eligible_inventory": lambda j: inventory.eligible_inventory(
            j.campaigns, j.apps, j.users
        ),
    }


def catalog() -> dict[str, Callable[[Jobs], DataFrame]]:
    return {
        **_funnel_and_reporting(),
        **_quality_alerts(),
        **_validation(),
        **_experiments(),
        **_monitoring(),
        **_dashboard(),
        **_upkeep(),
    }


def portable(df: DataFrame) -> DataFrame:
    """Column types that any engine's client renders alike.

    Rates and money are exact decimals up to here and already rounded, so
    DOUBLE shows the same digits; days and times become ISO text.
    """
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The catalog as (spark, folder) -> DataFrame callables."""

    def bind(job: Callable[[Jobs], DataFrame]):
        return lambda spark, folder: portable(job(Jobs(tune(spark), folder)))

    return {name: bind(job) for name, job in catalog().items()}
