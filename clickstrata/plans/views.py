"""Read-only results over the stored tables of a pipeline run.

The stored daily tables hold one row per day and campaign or app, so these
reads are small whatever the size of the event log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickstrata.operators import alerting, dashboard, reporting, validation
from clickstrata.plans.pipeline import Pipeline


def dashboard_views(
    pipeline: Pipeline, apps: DataFrame, publishers: DataFrame
) -> dict[str, DataFrame]:
    """The dashboard's datasets by name."""
    stored, campaigns = pipeline.warehouse, pipeline.inputs.campaigns
    daily_campaigns = stored.read("daily_campaign_metrics")
    daily_apps = stored.read("daily_app_metrics")
    results = stored.read("experiment_results")
    errors = stored.read("event_validation_errors")
    totals = dashboard.overview_totals(daily_campaigns)
    return {
        "overview_totals": totals,
        "overview_tiles": dashboard.overview_tiles(totals),
        "campaign_performance": dashboard.campaign_performance(
            daily_campaigns, campaigns
        ),
        "app_performance": dashboard.app_performance(daily_apps, apps, publishers),
        "chart_campaign_money": dashboard.chart_campaign_money(
            daily_campaigns, campaigns
        ),
        "chart_app_money": dashboard.chart_app_money(daily_apps, apps, publishers),
        "experiment_view": dashboard.experiment_view(results),
        "experiment_uplift_view": dashboard.experiment_uplift_view(results),
        "alerts_view": alerting.alerts_listing(pipeline.alerts),
        "alert_summary": alerting.alert_summary(pipeline.alerts),
        "validation_summary_view": validation.validation_error_summary(errors),
        "rejected_events_view": validation.rejected_events_view(errors),
    }


def report_views(
    pipeline: Pipeline, apps: DataFrame, publishers: DataFrame
) -> dict[str, DataFrame]:
    """Listings and rollups of the daily tables by name."""
    stored, campaigns = pipeline.warehouse, pipeline.inputs.campaigns
    by_campaign = stored.read("daily_campaign_metrics")
    by_app = stored.read("daily_app_metrics")
    return {
        "daily_campaign_by_profit": reporting.daily_campaign_by_profit(
            by_campaign, campaigns
        ),
        "daily_campaign_overview": reporting.daily_campaign_overview(
            by_campaign, campaigns
        ),
        "daily_app_overview": reporting.daily_app_overview(by_app, apps, publishers),
        "campaigns_best": reporting.campaigns_best(by_campaign, campaigns),
        "campaigns_worst": reporting.campaigns_worst(by_campaign, campaigns),
        "apps_by_revenue": reporting.apps_by_revenue(by_app, apps, publishers),
        "publisher_performance": reporting.publisher_performance(
            by_app, apps, publishers
        ),
        "country_platform_performance": reporting.country_platform_performance(
            by_campaign, campaigns
        ),
        "category_performance": reporting.category_performance(by_app, apps),
    }


def health_views(pipeline: Pipeline) -> dict[str, DataFrame]:
    """Counts and invariants of the stored tables by name."""
    stored, clean = pipeline.warehouse, pipeline.events_clean
    daily = stored.read("daily_campaign_metrics")
    return {
        "pipeline_counts": validation.stored_counts(pipeline.validated),
        "clean_event_distribution": validation.clean_event_distribution(clean),
        "check_clean_duplicates": validation.clean_duplicates(clean),
        "check_clean_orphans": validation.clean_orphans(
            clean, pipeline.inputs.ad_requests
        ),
        "check_daily_campaign_rows": reporting.volume(
            daily, "daily_campaign_metric_rows"
        ),
        "check_daily_app_rows": reporting.volume(
            stored.read("daily_app_metrics"), "daily_app_metric_rows"
        ),
        "check_null_kpis": reporting.null_kpi_rows(daily),
    }
