"""Rows at the borders of the rules."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hand_rows import Hand

from clickstrata.operators import (
    dashboard,
    experiments,
    inventory,
    monitoring,
    quality_alerts,
    reporting,
    validation,
)
from clickstrata.schemas import TABLES

D = Decimal


def errors_of(hand):
    rows = validation.validation_errors(hand.raw, hand.ad_requests).collect()
    return Counter((r["event_id"], r["error_type"]) for r in rows)


def test_one_event_may_break_several_rules(spark):
    hand = Hand(spark)
    request = hand.request("trk_1")
    hand.event(request, "click", event_id="x", country="FR", platform="ios")
    hand.event(request, "click", event_id="x", tracking_id=None)
    hand.event(request, "click", event_id="y", tracking_id="trk_other", country="FR")
    assert errors_of(hand) == {
        ("x", "duplicate_event_id"): 2,
        ("x", "country_mismatch"): 1,
        ("x", "platform_mismatch"): 1,
        ("x", "missing_tracking_id"): 1,
        ("y", "unknown_tracking_id"): 1,
    }
    assert validation.events_clean(hand.raw, hand.ad_requests).isEmpty()


@pytest.mark.parametrize("column", list(validation.MISMATCHES))
def test_null_value_is_a_mismatch_and_spelled_out(spark, column):
    hand = Hand(spark)
    request = hand.request("trk_1")
    hand.event(request, "click", event_id="x", **{column: None})
    (row,) = validation.validation_errors(hand.raw, hand.ad_requests).collect()
    assert row["error_type"] == validation.MISMATCHES[column]
    assert row["error_message"] == (
        f"Raw event x {column} NULL does not match ad request {column} "
        f"{request[column]}."
    )
    assert validation.events_clean(hand.raw, hand.ad_requests).isEmpty()


def test_all_copies_of_a_duplicate_are_rejected(spark):
    hand = Hand(spark)
    request = hand.request("trk_1")
    for _ in range(3):
        hand.event(request, "click", event_id="x")
    hand.event(request, "click", event_id="y")
    clean = validation.events_clean(hand.raw, hand.ad_requests)
    assert [r["event_id"] for r in clean.collect()] == ["y"]


def test_missing_money_counts_as_zero(spark):
    hand = Hand(spark)
    hand.campaign(1)
    request = hand.request("trk_1")
    hand.event(request, "impression", revenue=None, reward_cost=None)
    (clean,) = validation.events_clean(hand.raw, hand.ad_requests).collect()
    assert (clean["revenue"], clean["reward_cost"]) == (D("0.00"), D("0.00"))
    (row,) = reporting.campaign_kpi(hand.raw, hand.campaigns).collect()
    assert (row["revenue"], row["profit"]) == (D("0.00"), D("0.00"))


def test_scope_prefix_is_literal(spark):
    hand = Hand(spark)
    hand.event(hand.request("trk_py_1"), "click")
    hand.event(hand.request("trkXpyX1"), "click")
    rows = reporting.funnel_by_tracking(hand.raw, "trk_py_").collect()
    assert [r["tracking_id"] for r in rows] == ["trk_py_1"]


def test_campaign_without_impressions(spark):
    hand = Hand(spark)
    hand.campaign(1, "2.00")
    request = hand.request("trk_1")
    hand.event(request, "install", revenue="3.00")
    kpi = reporting.campaign_kpi(hand.raw, hand.campaigns).first()
    assert (kpi["ctr"], kpi["install_rate"], kpi["ecpm"]) == (None, None, D("0.00"))
    assert (kpi["spend"], kpi["profit"]) == (D("2.00"), D("1.00"))
    nullable = reporting.campaign_kpi(hand.raw, hand.campaigns, empty_ecpm=None).first()
    assert nullable["ecpm"] is None
    daily = reporting.daily_campaign_metrics(hand.raw, hand.campaigns)
    assert daily.first()["ctr"] == D("0.0000")
    assert reporting.null_kpi_rows(daily).first()[0] == 0


def test_event_day_and_request_day_differ_over_midnight(spark):
    hand = Hand(spark)
    hand.campaign(1)
    hand.experiment(1, "A")
    request = hand.request("trk_1", at=datetime(2026, 6, 1, 23, 59, 30))
    hand.event(request, "impression", event_time=datetime(2026, 6, 2, 0, 0, 10))
    daily = reporting.daily_campaign_metrics(hand.raw, hand.campaigns).first()
    assert daily["metric_date"] == date(2026, 6, 2)
    trend = experiments.experiment_daily_trend(
        hand.ad_requests, hand.raw, hand.experiments, hand.campaigns
    ).first()
    assert trend["request_date"] == date(2026, 6, 1)


def test_request_without_experiment_stays_out(spark):
    hand = Hand(spark)
    hand.campaign(1)
    hand.experiment(1, "A")
    hand.event(hand.request("trk_1"), "impression")
    hand.event(hand.request("trk_2", experiment_id=None), "impression")
    hand.request("trk_3", campaign_id=99)
    row = experiments.experiment_kpi(
        hand.ad_requests, hand.raw, hand.experiments, hand.campaigns
    ).first()
    assert (row["ad_requests"], row["impressions"]) == (1, 1)


def test_targeting_alert_skips_nulls(spark):
    hand = Hand(spark)
    hand.campaign(1, country="DE", platform="android")
    request = hand.request("trk_1")
    hand.event(request, "click", country=None, platform="ios")
    hand.event(request, "click", country="FR", platform=None)
    hand.event(request, "click", event_id="x", platform="ios")
    (row,) = quality_alerts.targeting_mismatch(hand.raw, hand.campaigns).collect()
    assert row["alert_message"].startswith("Targeting mismatch for event x:")


# --- monitoring thresholds ---------------------------------------------------


def daily_rows(spark, *rows):
    """Rows of (day, campaign, impressions, clicks, installs, spend, revenue, profit)."""
    schema = TABLES["daily_campaign_metrics"].schema
    full = []
    for day, campaign_id, impressions, clicks, installs, spend, revenue, profit in rows:
        values = dict.fromkeys(schema.names, 0)
        values.update(
            metric_date=date(2026, 6, day),
            campaign_id=campaign_id,
            impressions=impressions,
            clicks=clicks,
            installs=installs,
            spend=D(spend),
            revenue=D(revenue),
            profit=D(profit),
        )
        for name in ("ctr", "install_rate", "conversion_rate", "ecpm"):
            values[name] = D(0)
        full.append(tuple(values[name] for name in schema.names))
    return spark.createDataFrame(full, schema)


@pytest.fixture
def ten_campaigns(spark):
    hand = Hand(spark)
    for number in range(1, 11):
        hand.campaign(number)
    return hand.campaigns


def hit_campaigns(alerts):
    return sorted(int(r["entity_id"]) for r in alerts.collect())


def test_whole_period_thresholds(spark, ten_campaigns):
    daily = daily_rows(
        spark,
        (1, 1, 100, 22, 7, "0", "0", "-150.00"),  # exactly at every floor
        (1, 2, 100, 21, 7, "0", "0", "-150.01"),
        (1, 3, 99, 1, 0, "0", "0", "0"),  # too few impressions
        (1, 4, 100, 25, 8, "100.00", "0", "0"),  # install rate exactly 0.32
        (1, 5, 100, 25, 7, "100.01", "50.00", "0"),
        (1, 6, 100, 30, 30, "200.00", "100.00", "0"),  # return exactly 0.50
        (1, 7, 100, 0, 0, "0", "0", "0"),
    )

    def hits(rule_id):
        return hit_campaigns(monitoring.campaign_alerts(daily, ten_campaigns, rule_id))

    assert hits("mon_negative_profit") == [2]
    assert hits("mon_high_spend_low_revenue") == [5]
    assert hits("mon_low_ctr") == [2, 7]
    assert hits("mon_weak_install_rate") == [1, 5]
    together = monitoring.campaign_alerts(daily, ten_campaigns)
    assert together.count() == 6
    texts = {r["alert_message"] for r in together.collect()}
    assert (
        "[Generated Monitoring] Campaign 5 - Campaign 5 has high spend compared to "
        "revenue. Spend: 100.01, Revenue: 50.00, ROAS: 0.5000." in texts
    )


def test_daily_drop_thresholds(spark, ten_campaigns):
    daily = daily_rows(
        spark,
        (1, 1, 100, 30, 0, "0", "0", "0"),
        (4, 1, 100, 21, 0, "0", "0", "0"),  # drop of exactly 30 % after a gap
        (1, 2, 3, 2, 0, "0", "0", "0"),
        (2, 2, 30, 14, 0, "0", "0", "0"),  # 2/3 to 7/15 is exactly 30 % too
        (1, 3, 100, 30, 0, "0", "0", "0"),
        (2, 3, 1000, 211, 0, "0", "0", "0"),  # just below
        (1, 4, 100, 50, 0, "0", "0", "0"),
        (2, 4, 19, 0, 0, "0", "0", "0"),  # too few impressions
        (1, 5, 0, 5, 0, "0", "0", "0"),
        (2, 5, 100, 0, 0, "0", "0", "0"),  # nothing to fall from
        (1, 6, 100, 50, 0, "0", "0", "0"),
        (2, 6, 20, 0, 0, "0", "0", "0"),
    )
    alerts = monitoring.daily_ctr_drop(daily, ten_campaigns)
    assert hit_campaigns(alerts) == [1, 2, 6]
    texts = {r["alert_message"] for r in alerts.collect()}
    assert (
        "[Generated Monitoring] Campaign 1 - Campaign 1 CTR dropped by 30.00% on "
        "2026-06-04. Previous CTR: 0.3000, Current CTR: 0.2100." in texts
    )


def test_custom_thresholds(spark, ten_campaigns):
    daily = daily_rows(spark, (1, 1, 100, 50, 50, "0", "0", "-1.00"))
    limits = monitoring.Thresholds(profit_floor=D("0"))
    alerts = monitoring.campaign_alerts(
        daily, ten_campaigns, "mon_negative_profit", limits=limits
    )
    assert hit_campaigns(alerts) == [1]


def arms(spark, a, b):
    schema = TABLES["experiment_results"].schema
    rows = []
    for variant, values in (("A", a), ("B", b)):
        row = dict.fromkeys(schema.names, 0)
        for field in schema:
            if field.dataType.typeName() == "decimal":
                row[field.name] = D(0)
        row.update(
            experiment_name="ranking",
            variant=variant,
            algorithm_name=f"algorithm {variant}",
            calculated_at=datetime(2026, 6, 8),
            **{name: D(value) for name, value in values.items()},
        )
        rows.append(tuple(row[name] for name in schema.names))
    return spark.createDataFrame(rows, schema)


def test_uplift_over_a_zero_baseline_is_null(spark):
    results = arms(
        spark,
        {"ctr": "0.2000", "install_rate": "0", "conversion_rate": "0.3000", "profit": "10.00"},
        {"ctr": "0.2500", "install_rate": "0.1", "conversion_rate": "0.2000", "profit": "5.50"},
    )
    row = experiments.experiment_uplift(results).first()
    assert row["ctr_lift_percent"] == D("25.00")
    assert row["install_rate_lift_percent"] is None
    assert row["conversion_rate_lift_percent"] == D("-33.33")
    assert row["profit_delta"] == D("-4.50")
    view = dashboard.experiment_uplift_view(results).first()
    assert view["summary"] == (
        "Variant B improved CTR by 25.00%, install rate by NULL%, conversion rate by "
        "-33.33%, with a profit delta of -4.50."
    )


@pytest.mark.parametrize(("gain", "fires"), [("59.99", True), ("60.00", False)])
def test_experiment_tradeoff_threshold(spark, gain, fires):
    results = arms(
        spark,
        {"ctr": "0.2", "install_rate": "0.3", "conversion_rate": "0.4", "profit": "10.00"},
        {"ctr": "0.3", "install_rate": "0.4", "conversion_rate": "0.4", "profit": gain},
    )
    assert monitoring.experiment_tradeoff(results).isEmpty() is not fires


# --- inventory and empty input ---------------------------------------------


def test_inventory_keeps_campaigns_without_a_match(spark):
    hand = Hand(spark)
    hand.campaign(1, country="DE", platform="android", category="puzzle")
    hand.campaign(2, country="US", platform="ios", category="casino")
    hand.campaign(3, country="DE", platform="android", status="paused")
    apps = spark.createDataFrame(
        [(1, "puzzle", "android"), (2, "puzzle", "android"), (3, "puzzle", "ios")],
        "app_id long, category string, platform string",
    )
    users = spark.createDataFrame(
        [(1, "DE", "android"), (2, "DE", "ios")],
        "user_id long, country string, platform string",
    )
    rows = inventory.eligible_inventory(hand.campaigns, apps, users).collect()
    found = {r["campaign_id"]: (r["eligible_apps"], r["eligible_users"]) for r in rows}
    assert found == {1: (2, 1), 2: (0, 0)}


def test_empty_input(spark):
    hand = Hand(spark)
    hand.campaign(1)
    raw, requests = hand.raw, hand.ad_requests
    assert validation.validation_errors(raw, requests).isEmpty()
    assert tuple(validation.pipeline_counts(raw, requests).first()) == (0, 0, 0)
    daily = reporting.daily_campaign_metrics(raw, hand.campaigns)
    totals = dashboard.overview_totals(daily)
    row = totals.first()
    assert (row["impressions"], row["ctr"], row["profit"]) == (None, D("0.0000"), None)
    tiles = dashboard.overview_tiles(totals).first()
    assert (tiles["impressions"], tiles["profit"], tiles["ctr"]) == ("0", "0.00", "0.00%")
    alerts = quality_alerts.quality_alerts(raw, requests, hand.campaigns)
    assert alerts.isEmpty()


def test_rates_round_half_up_on_exact_decimals(spark):
    from clickstrata.functions import kpi

    counts = spark.createDataFrame(
        [(1, 160), (1, 3), (2, 3), (0, 7), (5, 0)], "clicks long, impressions long"
    )
    rows = [r[0] for r in counts.select(kpi.ctr()).collect()]
    assert rows == [D("0.0063"), D("0.3333"), D("0.6667"), D("0.0000"), None]


def test_times_keep_their_wall_clock(spark):
    hand = Hand(spark)
    moment = datetime(2026, 6, 1, 23, 30) + timedelta(minutes=45)
    hand.event(hand.request("trk_1"), "click", event_time=moment)
    row = reporting.daily_app_metrics(hand.raw).first()
    assert row["metric_date"] == date(2026, 6, 2)
