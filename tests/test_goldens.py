"""Hand-built funnels and anomalies with answers worked out by hand."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from hand_rows import seven_requests, with_faults

from clickstrata.operators import (
    alerting,
    experiments,
    quality_alerts,
    reporting,
    validation,
)

D = Decimal


@pytest.fixture(scope="module")
def good(spark):
    return seven_requests(spark)


@pytest.fixture(scope="module")
def mixed(spark):
    return with_faults(seven_requests(spark))


def test_funnel_per_request(good):
    rows = reporting.funnel_by_tracking(good.raw, "trk_hand_").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (1, 1, 1, 0, 2, D("0.00"), D("0.40")),
        (2, 1, 0, 0, 0, D("0.00"), D("0.00")),
        (1, 1, 1, 2, 0, D("9.75"), D("0.00")),
        (3, 0, 0, 0, 0, D("0.00"), D("0.00")),
        (1, 1, 1, 0, 0, D("0.00"), D("0.00")),
        (1, 2, 0, 0, 0, D("0.00"), D("0.00")),
    ]


# campaign: ctr, install_rate, conversion_rate, spend, revenue, reward_cost, profit, ecpm
KPIS = {
    5: ("1.0000", "1.0000", "1.0000", "1.80", "9.75", "0.40", "7.55", "4875.00"),
    4: ("0.0000", None, None, "0.00", "0.00", "0.00", "0.00", "0.00"),
    11: ("1.0000", "0.0000", None, "0.00", "0.00", "0.00", "0.00", "0.00"),
    8: ("1.0000", "1.0000", "0.0000", "3.35", "0.00", "0.00", "-3.35", "0.00"),
}
KPI_NAMES = (
    "ctr",
    "install_rate",
    "conversion_rate",
    "spend",
    "revenue",
    "reward_cost",
    "profit",
    "ecpm",
)


def test_campaign_kpi(good):
    rows = reporting.campaign_kpi(good.raw, good.campaigns, "trk_hand_").collect()
    assert [r["campaign_id"] for r in rows] == [5, 4, 11, 8]
    for row in rows:
        expected = [None if v is None else D(v) for v in KPIS[row["campaign_id"]]]
        assert [row[name] for name in KPI_NAMES] == expected


def test_daily_campaign_metrics_shows_zero_for_missing_rates(good):
    rows = reporting.daily_campaign_metrics(good.raw, good.campaigns).collect()
    assert "reward_cost" not in rows[0].asDict()
    assert {str(r["metric_date"]) for r in rows} == {"2026-06-01"}
    found = {r["campaign_id"]: r for r in rows}
    for campaign_id, values in KPIS.items():
        for name, value in zip(KPI_NAMES, values, strict=True):
            if name != "reward_cost":
                assert found[campaign_id][name] == D(value or 0)


def test_quality_alerts(mixed):
    alerts = quality_alerts.quality_alerts(mixed.raw, mixed.ad_requests, mixed.campaigns)
    rows = alerts.collect()
    assert Counter(r["rule_id"] for r in rows) == {
        "dq_missing_or_unknown_tracking": 2,
        "dq_duplicate_event_id": 1,
        "dq_duplicate_installs": 1,
        "dq_click_without_impression": 1,
        "dq_install_without_click": 1,
        "dq_targeting_mismatch": 1,
        "perf_clicks_without_installs": 2,
    }
    assert not any(r["is_resolved"] for r in rows)
    messages = {r["alert_message"] for r in rows}
    assert {
        "Event hand_23 has missing or unknown tracking_id: NULL",
        "Duplicate event_id detected: thrice appears 3 times in events_raw.",
        "Duplicate install problem: tracking_id trk_hand_003 has 4 install events.",
        "Funnel issue: tracking_id trk_only_click has clicks but no impressions.",
        "Attribution issue: tracking_id trk_astray has installs but no clicks.",
        "Targeting mismatch for event hand_29: campaign targets GB/ios but event has "
        "NO/ios.",
        "Campaign 11 has 4 clicks but zero installs.",
        "Campaign 4 has 1 clicks but zero installs.",
    } <= messages


def test_alert_listing_is_ranked_by_severity(mixed):
    alerts = quality_alerts.quality_alerts(mixed.raw, mixed.ad_requests, mixed.campaigns)
    severities = [r["severity"] for r in alerting.alerts_listing(alerts).collect()]
    assert severities == ["high"] * 4 + ["medium"] * 3 + ["low"] * 2
    summary = alerting.alert_summary(alerts).collect()
    assert [tuple(r) for r in summary] == [
        ("data_quality", "high", 4),
        ("data_quality", "medium", 3),
        ("performance", "low", 2),
    ]


def test_validation_split(mixed):
    errors = validation.validation_errors(mixed.raw, mixed.ad_requests)
    assert Counter(r["error_type"] for r in errors.collect()) == {
        "missing_tracking_id": 1,
        "unknown_tracking_id": 1,
        "duplicate_event_id": 3,
        "app_mismatch": 1,
        "user_mismatch": 1,
        "country_mismatch": 1,
    }
    clean = validation.events_clean(mixed.raw, mixed.ad_requests)
    assert Counter(r["event_type"] for r in clean.collect()) == {
        "impression": 9,
        "click": 7,
        "install": 3,
        "reward": 2,
        "conversion": 2,
    }
    counts = validation.pipeline_counts(mixed.raw, mixed.ad_requests).first()
    assert tuple(counts) == (31, 23, 8)
    assert validation.clean_duplicates(clean).isEmpty()
    assert validation.clean_orphans(clean, mixed.ad_requests).isEmpty()


def test_single_rules_add_up_to_the_one_pass_errors(mixed):
    together = validation.validation_errors(mixed.raw, mixed.ad_requests).collect()
    apart = [
        row
        for error_type in validation.ERROR_TYPES
        for row in validation.single_rule_errors(
            error_type, mixed.raw, mixed.ad_requests
        ).collect()
    ]
    assert Counter(map(tuple, together)) == Counter(map(tuple, apart))


def test_experiment_results_count_unserved_requests(good):
    results = experiments.experiment_results(
        good.ad_requests, good.raw, good.experiments, good.campaigns
    ).collect()
    by_variant = {r["variant"]: r for r in results}
    # A holds requests 2, 4 and 6; B holds 1, 3, 7 and 5, which has no events.
    a, b = by_variant["A"], by_variant["B"]
    assert (a["ad_requests"], a["impressions"], a["clicks"], a["installs"]) == (3, 6, 2, 1)
    assert (b["ad_requests"], b["impressions"], b["clicks"], b["installs"]) == (4, 3, 4, 2)
    assert (a["spend"], a["revenue"], a["profit"]) == (D("3.35"), D("0.00"), D("-3.35"))
    assert (b["spend"], b["revenue"], b["profit"]) == (D("1.80"), D("9.75"), D("7.55"))
    assert (a["ctr"], b["ctr"]) == (D("0.3333"), D("1.3333"))
