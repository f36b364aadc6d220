"""The batch run: raw events and requests in, every reporting table out.

Order: validation, daily metrics, experiments, alerts.  Each step reads what
the step before stored, so no step recomputes another's work.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.operators import (
    alerting,
    experiments,
    incremental,
    maintenance,
    monitoring,
    quality_alerts,
    reporting,
    validation,
)
from clickstrata.operators.monitoring import DEFAULTS, Thresholds
from clickstrata.sources.tables import KeyRange, Warehouse, logged

# Raw events with their errors, split by outcome: the clean half is read as
# the clean table, the other half holds few rows and yields the error log.
VALIDATED = "events_validated"

# How often each event id was seen: what validating a new batch has to know.
COPIES = "event_copies"

# What the daily tables are summed from, by the key that each is kept for.
DAILY_SUMS = {"campaign_id": "daily_campaign_sums", "app_id": "daily_app_sums"}

# One alert log in two folders.  Quality alerts grow with the events, those of
# the monitoring do not, so refreshing one kind never rewrites the other.
QUALITY_ALERTS = "alerts_quality"
MONITORING_ALERTS = "alerts_monitoring"


@dataclass(frozen=True)
class Inputs:
    events_raw: DataFrame
    ad_requests: DataFrame
    campaigns: DataFrame
    experiments: DataFrame


@dataclass(frozen=True)
class Pipeline:
    """A full refresh, step by step or at once."""

    warehouse: Warehouse
    inputs: Inputs
    scope: str | None = None
    limits: Thresholds = DEFAULTS

    def run(self) -> None:
        self.validate()
        self.refresh_daily_metrics()
        self.compare_experiments()
        self.check_quality()
        self.monitor()

    # --- validation ---------------------------------------------------------

    def validate(self) -> None:
        """Classify every raw event once and store both halves in one write."""
        classified = validation.classify_events(
            self.inputs.events_raw, self.inputs.ad_requests
        )
        # A name of its own tells the tables that follow from this run from others.
        run = [f"full-{uuid.uuid4().hex}"]
        self.warehouse.full_refresh(VALIDATED, _by_outcome(classified), run)
        self._store_errors(run)

    def _store_errors(self, names: Sequence[str]) -> None:
        errors = logged(validation.errors_of(self._half(False)))
        self.warehouse.full_refresh("event_validation_errors", errors, names)

    def take_in(
        self, events: DataFrame, batch: str, late_requests: DataFrame | None = None
    ) -> list[date]:
        """Validate a new batch, put right what it changes, and refresh those days.

        The result is that of a full run over all batches.  Besides the batch itself
        this reads the counts of its ids' buckets and the days that hold a row that a
        late copy spoils.  ``late_requests`` are requests that came after events of
        theirs; ``inputs.ad_requests`` has to hold them as well.

        The daily tables follow by differences: the clean events that the batch brings
        or spoils are summed, added to the stored sums, and the touched days computed
        from these, so that no other event of those days is read.

        Each table commits the batch's name with its rows, so repeating a batch after
        a failure adds nothing twice, and a table that missed a batch is computed
        again from the validated events.  Returns the days that were refreshed.
        """
        self._catch_up()
        if batch in self.warehouse.landed(VALIDATED):
            return []
        requests = self.inputs.ad_requests
        stored = self.validated
        columns = [c for c in stored.columns if c not in ("errors", "is_clean", "event_date")]
        events = events.select(*columns)
        arrived = incremental.copies_of(events)
        seen = incremental.seen_before(self.warehouse.scan(COPIES), arrived).persist()
        spoiled = incremental.spoiled_by(seen)
        days = [row[0] for row in spoiled.select("event_date").distinct().collect()]
        of_days = stored.filter(F.col("event_date").isin(*days)) if days else stored.limit(0)
        redone = of_days.join(spoiled.select("event_id"), "event_id", "left_semi")
        if late_requests is not None:
            waiting = stored.filter(~F.col("is_clean")).join(
                late_requests.select("tracking_id"), "tracking_id", "left_semi"
            )
            redone = redone.unionByName(waiting.join(redone.select("raw_event_id"), "raw_event_id", "left_anti"))
        redone = redone.persist()
        fresh = validation.classify_events(
            events, requests, incremental.repeated_in(arrived, seen)
        )
        again = incremental.classified_again(redone, spoiled, requests, columns)
        classified = _by_outcome(fresh.unionByName(again)).persist()
        old = redone.select("raw_event_id", "event_date")
        touched = {row[0] for row in old.select("event_date").distinct().collect()}
        self.warehouse.replace_joined(
            VALIDATED,
            old,
            "raw_event_id",
            classified,
            batch,
            [KeyRange("event_date", day, day + timedelta(1)) for day in touched],
        )
        self.warehouse.append(COPIES, arrived, batch)
        new_days = events.select(F.to_date("event_time")).distinct().collect()
        touched |= {row[0] for row in new_days if row[0] is not None}
        if touched:
            dated = classified.filter(F.col("event_date").isNotNull())
            errors = logged(validation.errors_of(dated))
            self.warehouse.replace_joined(
                "event_validation_errors", old, "raw_event_id", errors, batch
            )
            changes = incremental.clean_changes(redone, classified)
            for key, name in DAILY_SUMS.items():
                self.warehouse.append(
                    name, reporting.daily_sums(changes, key, self.scope), batch
                )
            self._publish_days(sorted(touched), batch)
        classified.unpersist()
        seen.unpersist()
        redone.unpersist()
        return sorted(touched)

    def _catch_up(self) -> None:
        """Compute again what does not hold the batches that the validated events hold."""
        if not self.warehouse.exists(VALIDATED):
            self.warehouse.full_refresh(
                VALIDATED,
                _by_outcome(
                    validation.classify_events(
                        self.inputs.events_raw.limit(0), self.inputs.ad_requests
                    )
                ),
                [],
            )
        names = self.warehouse.landed(VALIDATED)

        def behind(name: str) -> bool:
            return not self.warehouse.exists(name) or self.warehouse.landed(name) != names

        if behind(COPIES):
            self.warehouse.full_refresh(COPIES, incremental.copies_of(self.validated), names)
        if behind("event_validation_errors"):
            self._store_errors(sorted(names))
        if any(map(behind, (*DAILY_SUMS.values(), "daily_campaign_metrics", "daily_app_metrics"))):
            self.refresh_daily_metrics()

    def purge(self, scope: maintenance.Scope) -> list[date]:
        """Delete a scope from the stored tables and refresh the days that held it.

        Results that span days are brought up to date by ``compare_experiments``,
        ``check_quality`` and ``monitor``.
        """
        days = maintenance.purge_warehouse(self.warehouse, scope)
        self.refresh_days(days)
        if self.warehouse.exists(COPIES):
            names = self.warehouse.landed(VALIDATED)
            self.warehouse.full_refresh(COPIES, incremental.copies_of(self.validated), names)
        return days

    @property
    def validated(self) -> DataFrame:
        """Every raw event with its errors and ``is_clean``."""
        return self.warehouse.scan(VALIDATED)

    def _half(self, clean: bool) -> DataFrame:
        return self.validated.filter(F.col("is_clean") == F.lit(clean))

    @property
    def events_clean(self) -> DataFrame:
        return validation.clean_of(self._half(True))

    # --- daily metrics ------------------------------------------------------

    def refresh_daily_metrics(self) -> None:
        """Sum all clean events anew; also merges what batches have added."""
        clean = self.events_clean.withColumn("sign", F.lit(1).cast("long"))
        names = self.warehouse.landed(VALIDATED)
        for key, name in DAILY_SUMS.items():
            sums = reporting.daily_sums(clean, key, self.scope)
            self.warehouse.full_refresh(name, sums, names)
        self.warehouse.full_refresh(
            "daily_campaign_metrics",
            reporting.daily_campaign_of_sums(
                self._sums("campaign_id"), self.inputs.campaigns
            ),
            names,
        )
        self.warehouse.full_refresh(
            "daily_app_metrics", reporting.daily_app_of_sums(self._sums("app_id")), names
        )

    def refresh_days(self, days: Sequence[date]) -> None:
        """Recompute only some days and replace exactly their partitions.

        Validated events lie by day, so only those days are read.
        """
        if not days:
            return
        if not all(map(self.warehouse.exists, DAILY_SUMS.values())):
            # A warehouse written before there were sums.
            self.refresh_daily_metrics()
            return
        clean = self.clean_of_days(days).withColumn("sign", F.lit(1).cast("long"))
        for key, name in DAILY_SUMS.items():
            sums = reporting.daily_sums(clean, key, self.scope)
            self.warehouse.refresh_days(name, sums, days)
        self._publish_days(days)

    def _sums(self, key: str, days: Sequence[date] | None = None) -> DataFrame:
        sums = self.warehouse.scan(DAILY_SUMS[key])
        return sums if days is None else sums.filter(F.col("metric_date").isin(*days))

    def _publish_days(self, days: Sequence[date], batch: str | None = None) -> None:
        """Replace these days of the daily tables by what their sums give."""
        self.warehouse.refresh_days(
            "daily_campaign_metrics",
            reporting.daily_campaign_of_sums(
                self._sums("campaign_id", days), self.inputs.campaigns
            ),
            days,
            batch,
        )
        self.warehouse.refresh_days(
            "daily_app_metrics",
            reporting.daily_app_of_sums(self._sums("app_id", days)),
            days,
            batch,
        )

    def clean_of_days(self, days: Sequence[date]) -> DataFrame:
        dated = self._half(True).filter(F.col("event_date").isin(*days))
        return validation.clean_of(dated)

    # --- experiments --------------------------------------------------------

    def compare_experiments(self) -> None:
        """Experiments read raw events by design, as rejected ones count too."""
        results = experiments.experiment_results(
            self.inputs.ad_requests,
            self.inputs.events_raw,
            self.inputs.experiments,
            self.inputs.campaigns,
            self.scope,
        )
        self.warehouse.full_refresh(
            "experiment_results", logged(results, "calculated_at")
        )

    # --- alerts -------------------------------------------------------------

    def check_quality(self) -> None:
        """Replace the data-quality alerts, leaving the monitoring ones alone."""
        fresh = quality_alerts.quality_alerts(
            self.inputs.events_raw,
            self.inputs.ad_requests,
            self.inputs.campaigns,
            errors=self.warehouse.read("event_validation_errors"),
        )
        self.warehouse.full_refresh(QUALITY_ALERTS, logged(fresh))

    def monitor(self) -> None:
        """Replace the monitoring alerts, leaving the data-quality ones alone."""
        fresh = monitoring.monitoring_alerts(
            self.warehouse.read("daily_campaign_metrics"),
            self.inputs.campaigns,
            self.warehouse.read("experiment_results"),
            self.limits,
        )
        self.warehouse.full_refresh(MONITORING_ALERTS, logged(fresh))

    @property
    def alerts(self) -> DataFrame:
        """The whole alert log."""
        return alerting.union_alerts(
            self.warehouse.read(QUALITY_ALERTS, declared_as="alerts"),
            self.warehouse.read(MONITORING_ALERTS, declared_as="alerts"),
        )


def _by_outcome(classified: DataFrame) -> DataFrame:
    """Classified events with what their table is laid out by."""
    return classified.withColumns(
        {"is_clean": F.col("errors").isNull(), "event_date": F.to_date("event_time")}
    )
