"""Removing one id scope from all fact tables in dependency order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.sources.tables import (
    KeyRange,
    Warehouse,
    starts_with_any,
    survivors,
    survivors_of_join,
)


@dataclass(frozen=True)
class Scope:
    """The id prefixes that mark one load."""

    event_prefix: str
    tracking_prefix: str

    def events(self) -> Column:
        return starts_with_any(
            ("event_id", "tracking_id"), (self.event_prefix, self.tracking_prefix)
        )

    def requests(self) -> Column:
        return F.col("tracking_id").startswith(self.tracking_prefix)

    def request_ranges(self) -> list[KeyRange]:
        return [KeyRange.of_prefix("tracking_id", self.tracking_prefix)]

    def event_ranges(self) -> list[KeyRange]:
        """Where events of the scope lie, for the files' least and greatest keys."""
        return [KeyRange.of_prefix("event_id", self.event_prefix), *self.request_ranges()]


@dataclass(frozen=True)
class FactTables:
    """The tables a purge touches, children before parents."""

    event_validation_errors: DataFrame
    events_clean: DataFrame
    events_raw: DataFrame
    ad_requests: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return list(vars(self).items())


def purged(tables: FactTables, scope: Scope) -> FactTables:
    """What stays of each table once the scope is removed.

    Errors go by their raw event, not by their own text, so an error row whose
    ids were lost still follows the event it belongs to.
    """
    doomed_events = tables.events_raw.filter(scope.events()).select("raw_event_id")
    return FactTables(
        event_validation_errors=survivors_of_join(
            tables.event_validation_errors, doomed_events, "raw_event_id"
        ),
        events_clean=survivors(tables.events_clean, scope.events()),
        events_raw=survivors(tables.events_raw, scope.events()),
        ad_requests=survivors(tables.ad_requests, scope.requests()),
    )


def survivor_counts(tables: FactTables, scope: Scope) -> DataFrame:
    """Rows left per table after a purge of the scope."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("survivors")).select(
            F.lit(name).alias("table_name"), "survivors"
        )
        for name, table in purged(tables, scope).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


# What the pipeline stores of the events and requests, children before parents;
# the clean events are the clean half of the validated ones.
STORED = ("event_validation_errors", "events_validated", "events_raw", "ad_requests")


def purge_warehouse(warehouse: Warehouse, scope: Scope) -> list[date]:
    """Delete the scope from the stored tables, referencing tables first.

    Only files that hold rows of the scope are rewritten.  Returns the days whose
    clean events were touched: the daily tables, A/B results and alerts computed
    from them still count the purged rows until they are refreshed
    (``Pipeline.purge`` does both).
    """
    missing = [name for name in STORED if not warehouse.exists(name)]
    if missing:
        raise FileNotFoundError(f"nothing was deleted; not stored: {missing}")
    ranges = scope.event_ranges()
    raw = warehouse.scan("events_raw", ranges)
    doomed_events = raw.filter(scope.events()).select("raw_event_id")
    clean = warehouse.scan("events_validated", ranges).filter(scope.events() & F.col("is_clean"))
    days = [row["event_date"] for row in clean.select("event_date").distinct().collect()]
    warehouse.delete_joined("event_validation_errors", doomed_events, "raw_event_id")
    warehouse.delete_where("events_validated", scope.events(), ranges)
    warehouse.delete_where("events_raw", scope.events(), ranges)
    warehouse.delete_where("ad_requests", scope.requests(), scope.request_ranges())
    return sorted(day for day in days if day is not None)
