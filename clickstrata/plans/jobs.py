"""The hand-offs between the jobs, from raw events to alerts.

Everything is lazy: building a query writes nothing.  Equal branches of one query
share their exchanges; the batch pipeline stores the tables between its steps.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from clickstrata.operators import (
    alerting,
    experiments,
    monitoring,
    quality_alerts,
    reporting,
    validation,
)
from clickstrata.sources.driver_mapping import DriverTables

# Fixed value: the id prefix the reporting jobs are scoped to.
REPORTING_SCOPE = "trk_py_"


class Jobs(DriverTables):
    """The derived tables of the pipeline over one input folder."""

    scope = REPORTING_SCOPE

    @cached_property
    def duplicates(self) -> DataFrame:
        return validation.duplicate_event_ids(self.events_raw)

    @cached_property
    def events_clean(self) -> DataFrame:
        return validation.events_clean(self.events_raw, self.ad_requests)

    @cached_property
    def validation_errors(self) -> DataFrame:
        return validation.validation_errors(self.events_raw, self.ad_requests)

    @cached_property
    def daily_campaign(self) -> DataFrame:
        return reporting.daily_campaign_metrics(
            self.events_clean, self.campaigns, self.scope
        )

    @cached_property
    def daily_app(self) -> DataFrame:
        return reporting.daily_app_metrics(self.events_clean, self.scope)

    @cached_property
    def experiment_results(self) -> DataFrame:
        return experiments.experiment_results(
            self.ad_requests,
            self.events_raw,
            self.experiments,
            self.campaigns,
            self.scope,
        )

    @cached_property
    def quality_alerts(self) -> DataFrame:
        return quality_alerts.quality_alerts(
            self.events_raw, self.ad_requests, self.campaigns
        )

    @cached_property
    def monitoring_alerts(self) -> DataFrame:
        return monitoring.monitoring_alerts(
            self.daily_campaign, self.campaigns, self.experiment_results
        )

    @cached_property
    def alerts(self) -> DataFrame:
        """The alert log after both rule groups have run."""
        return alerting.refresh_alerts(
            self.quality_alerts, self.monitoring_alerts, alerting.MONITORING_GROUPS
        )
