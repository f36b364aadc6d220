"""Rule-based alerts on all raw events, whatever their id scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions import kpi
from clickstrata.functions.rules import Rule, emit
from clickstrata.functions.text import shown
from clickstrata.operators.alerting import (
    DATA_QUALITY,
    AlertKind,
    open_alerts,
    union_alerts,
)
from clickstrata.operators.validation import maybe_repeated


def _lost_tracking() -> Rule:
    kind = AlertKind(
        "dq_missing_or_unknown_tracking", DATA_QUALITY, "data_quality", "high", "tracking_id"
    )
    tracking_id = shown(F.col("tracking_id"))
    return kind.rule(
        F.lit(True),
        tracking_id,
        "Event ",
        F.col("event_id"),
        " has missing or unknown tracking_id: ",
        tracking_id,
    )


def _repeated_event() -> Rule:
    kind = AlertKind(
        "dq_duplicate_event_id", DATA_QUALITY, "data_quality", "high", "system"
    )
    return kind.rule(
        F.col("copies") > 1,
        F.col("event_id"),
        "Duplicate event_id detected: ",
        F.col("event_id"),
        " appears ",
        F.col("copies"),
        " times in events_raw.",
    )


def missing_or_unknown_tracking(raw: DataFrame, requests: DataFrame) -> DataFrame:
    """One alert per event without a tracking id or with an unknown one."""
    events = raw.select("event_id", "tracking_id")
    # Without a tracking id there is nothing to look up, so those rows stay where they are.
    unknown = events.filter(F.col("tracking_id").isNotNull()).join(
        requests.select("tracking_id"), "tracking_id", "left_anti"
    )
    lost = events.filter(F.col("tracking_id").isNull()).unionByName(unknown)
    return emit(lost, [_lost_tracking()])


def duplicate_event_id(raw: DataFrame) -> DataFrame:
    """One alert per event id that occurs more than once."""
    copies = maybe_repeated(raw).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    return emit(copies, [_repeated_event()])


def identity_alerts_from_errors(errors: DataFrame) -> DataFrame:
    """The two rules above, read off the stored validation errors.

    The error log has a row per event with a missing or unknown tracking id
    and one per copy of a duplicated event id, so neither the join with the
    requests nor the count over all event ids has to run again.
    """
    lost = errors.filter(
        F.col("error_type").isin("missing_tracking_id", "unknown_tracking_id")
    )
    copies = (
        errors.filter(F.col("error_type") == "duplicate_event_id")
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return union_alerts(
        emit(lost, [_lost_tracking()]), emit(copies, [_repeated_event()])
    )


def _duplicate_installs() -> Rule:
    kind = AlertKind(
        "dq_duplicate_installs", DATA_QUALITY, "data_quality", "high", "tracking_id"
    )
    return kind.rule(
        F.col("installs") > 1,
        F.col("tracking_id"),
        "Duplicate install problem: tracking_id ",
        F.col("tracking_id"),
        " has ",
        F.col("installs"),
        " install events.",
    )


def _click_without_impression() -> Rule:
    kind = AlertKind(
        "dq_click_without_impression", DATA_QUALITY, "data_quality", "medium", "tracking_id"
    )
    return kind.rule(
        (F.col("clicks") > 0) & (F.col("impressions") == 0),
        F.col("tracking_id"),
        "Funnel issue: tracking_id ",
        F.col("tracking_id"),
        " has clicks but no impressions.",
    )


def _install_without_click() -> Rule:
    kind = AlertKind(
        "dq_install_without_click", DATA_QUALITY, "data_quality", "medium", "tracking_id"
    )
    return kind.rule(
        (F.col("installs") > 0) & (F.col("clicks") == 0),
        F.col("tracking_id"),
        "Attribution issue: tracking_id ",
        F.col("tracking_id"),
        " has installs but no clicks.",
    )


def _funnel_of(raw: DataFrame, *event_types: str) -> DataFrame:
    """Event counts per known tracking id, from the event types that matter."""
    return (
        raw.filter(
            F.col("tracking_id").isNotNull() & F.col("event_type").isin(*event_types)
        )
        .groupBy("tracking_id")
        .agg(*kpi.funnel_counts(*event_types))
    )


def duplicate_installs(raw: DataFrame) -> DataFrame:
    return emit(_funnel_of(raw, "install"), [_duplicate_installs()])


def click_without_impression(raw: DataFrame) -> DataFrame:
    return emit(_funnel_of(raw, "impression", "click"), [_click_without_impression()])


def install_without_click(raw: DataFrame) -> DataFrame:
    return emit(_funnel_of(raw, "click", "install"), [_install_without_click()])


def funnel_alerts(raw: DataFrame) -> DataFrame:
    """The three per-request funnel rules from one aggregate."""
    return emit(
        _funnel_of(raw, "impression", "click", "install"),
        [
            _duplicate_installs(),
            _click_without_impression(),
            _install_without_click(),
        ],
    )


def targeting_mismatch(raw: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One alert per event whose known country or platform misses the target.

    Unlike validation this compares with the campaign and skips NULLs.
    """
    kind = AlertKind(
        "dq_targeting_mismatch", DATA_QUALITY, "data_quality", "medium", "campaign"
    )
    rule = kind.rule(
        F.col("country").isNotNull()
        & F.col("platform").isNotNull()
        & (
            (F.col("country") != F.col("target_country"))
            | (F.col("platform") != F.col("target_platform"))
        ),
        F.col("campaign_id"),
        "Targeting mismatch for event ",
        F.col("event_id"),
        ": campaign targets ",
        F.col("target_country"),
        "/",
        F.col("target_platform"),
        " but event has ",
        F.col("country"),
        "/",
        F.col("platform"),
        ".",
    )
    aimed = raw.select("event_id", "campaign_id", "country", "platform").join(
        campaigns.select("campaign_id", "target_country", "target_platform"),
        "campaign_id",
    )
    return emit(aimed, [rule])


def clicks_without_installs(raw: DataFrame) -> DataFrame:
    kind = AlertKind(
        "perf_clicks_without_installs", DATA_QUALITY, "performance", "low", "campaign"
    )
    counts = (
        raw.filter(
            F.col("campaign_id").isNotNull()
            & F.col("event_type").isin("click", "install")
        )
        .groupBy("campaign_id")
        .agg(*kpi.funnel_counts("click", "install"))
    )
    rule = kind.rule(
        (F.col("clicks") > 0) & (F.col("installs") == 0),
        F.col("campaign_id"),
        "Campaign ",
        F.col("campaign_id"),
        " has ",
        F.col("clicks"),
        " clicks but zero installs.",
    )
    return emit(counts, [rule])


def quality_alerts(
    raw: DataFrame,
    requests: DataFrame,
    campaigns: DataFrame,
    errors: DataFrame | None = None,
) -> DataFrame:
    """All seven rules as one bag of open alerts.

    With the stored validation ``errors`` the identity rules read those
    instead of raw events and requests.
    """
    if errors is None:
        identity = union_alerts(
            missing_or_unknown_tracking(raw, requests), duplicate_event_id(raw)
        )
    else:
        identity = identity_alerts_from_errors(errors)
    return open_alerts(
        union_alerts(
            identity,
            funnel_alerts(raw),
            targeting_mismatch(raw, campaigns),
            clicks_without_installs(raw),
        )
    )
