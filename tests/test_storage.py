"""Sinks, deletes, the batch pipeline and the constraint audit."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from hand_rows import plan_of, seven_requests, with_faults
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from clickstrata.operators import alerting, audit, maintenance, reporting
from clickstrata.plans.pipeline import (
    MONITORING_ALERTS,
    QUALITY_ALERTS,
    Inputs,
    Pipeline,
)
from clickstrata.plans.catalog import catalog, registered
from clickstrata.plans.jobs import Jobs
from clickstrata.plans.views import dashboard_views, health_views, report_views
from clickstrata.session import tune
from clickstrata.sources.tables import Warehouse


def pipeline_over(spark, root, hand):
    inputs = Inputs(hand.raw, hand.ad_requests, hand.campaigns, hand.experiments)
    return Pipeline(Warehouse(spark, str(root)), inputs)


@pytest.fixture
def mixed(spark):
    return with_faults(seven_requests(spark))


def test_pipeline_stores_every_table(spark, tmp_path, mixed):
    pipeline = pipeline_over(spark, tmp_path, mixed)
    pipeline.run()
    warehouse = pipeline.warehouse
    assert pipeline.events_clean.count() == 23
    errors = warehouse.read("event_validation_errors")
    assert errors.count() == 8
    assert errors.filter(F.col("detected_at").isNull()).isEmpty()
    daily = warehouse.read("daily_campaign_metrics")
    assert daily.agg(F.sum("impressions")).first()[0] == 9
    files = warehouse.files("daily_campaign_metrics")
    assert files and all("/metric_date=2026-06-01/" in path for path in files)
    assert warehouse.read("experiment_results").count() == 2
    groups = Counter(r["rule_group"] for r in pipeline.alerts.collect())
    assert groups["data_quality"] == 9


def test_stored_views_equal_the_registered_queries(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    jobs = Jobs(spark, folder)
    # The fixture's event keys are text, which the declared schema is not.
    numbered = jobs.events_raw.withColumn("raw_event_id", F.xxhash64("raw_event_id"))
    inputs = Inputs(numbered, jobs.ad_requests, jobs.campaigns, jobs.experiments)
    pipeline = Pipeline(Warehouse(spark, str(tmp_path)), inputs, jobs.scope)
    pipeline.run()
    views = {
        **dashboard_views(pipeline, jobs.apps, jobs.publishers),
        **report_views(pipeline, jobs.apps, jobs.publishers),
        **health_views(pipeline),
    }
    stamped = {"detected_at", "raw_event_id"}
    for name, view in views.items():
        expected = catalog()[name](jobs)
        columns = sorted(set(expected.columns) - stamped)
        assert sorted(set(view.columns) - stamped) == columns, name
        found = Counter(map(tuple, view.select(*columns).collect()))
        assert found == Counter(map(tuple, expected.select(*columns).collect())), name


def test_pipeline_can_run_again(spark, tmp_path, mixed):
    pipeline = pipeline_over(spark, tmp_path, mixed)
    pipeline.run()
    before = pipeline.alerts.count()
    pipeline.run()
    assert pipeline.alerts.count() == before
    assert pipeline.events_clean.count() == 23


def test_monitoring_refresh_leaves_quality_alerts_and_drops_stale_ones(
    spark, tmp_path, mixed
):
    pipeline = pipeline_over(spark, tmp_path, mixed)
    pipeline.run()
    warehouse = pipeline.warehouse
    before = Counter(r["rule_group"] for r in pipeline.alerts.collect())
    assert before["data_quality"] == 9
    stale = warehouse.read(QUALITY_ALERTS, declared_as="alerts").limit(1)
    stale = stale.withColumn("rule_group", F.lit(alerting.GENERATED_MONITORING))
    warehouse.append(MONITORING_ALERTS, stale)
    assert pipeline.alerts.count() == sum(before.values()) + 1
    pipeline.monitor()
    groups = Counter(r["rule_group"] for r in pipeline.alerts.collect())
    assert groups == before


def test_refresh_of_some_days_leaves_the_others(spark, tmp_path):
    hand = seven_requests(spark)
    late = hand.request("trk_next_day", 4, at=datetime(2026, 6, 2, 9))
    hand.event(late, "impression")
    pipeline = pipeline_over(spark, tmp_path, hand)
    pipeline.validate()
    pipeline.refresh_daily_metrics()
    warehouse = pipeline.warehouse

    def of_day(day):
        files = warehouse.files("daily_campaign_metrics")
        return [path for path in files if f"metric_date={day}" in path]

    before = of_day("2026-06-01"), of_day("2026-06-02")
    pipeline.refresh_days([date(2026, 6, 2)])
    assert of_day("2026-06-01") == before[0]
    assert of_day("2026-06-02") and of_day("2026-06-02") != before[1]
    daily = pipeline.warehouse.read("daily_campaign_metrics")
    assert daily.agg(F.sum("impressions")).first()[0] == 10


def test_delete_keeps_rows_whose_predicate_is_null(spark, tmp_path, mixed):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.full_refresh("events_raw", mixed.raw)
    left = warehouse.delete_where("events_raw", F.col("tracking_id").startswith("trk_hand_"))
    assert {r["tracking_id"] for r in left.collect()} == {
        None,
        "trk_astray",
        "trk_only_click",
    }


def test_purge_after_a_run_leaves_nothing_of_the_scope(spark, tmp_path, mixed):
    pipeline = pipeline_over(spark, tmp_path, mixed)
    pipeline.run()
    warehouse = pipeline.warehouse
    scope = maintenance.Scope(event_prefix="thrice", tracking_prefix="trk_hand_001")
    with pytest.raises(FileNotFoundError):
        maintenance.purge_warehouse(warehouse, scope)
    assert warehouse.read("event_validation_errors").count() == 8
    warehouse.full_refresh("events_raw", mixed.raw)
    warehouse.full_refresh("ad_requests", mixed.ad_requests)
    expected = {"event_validation_errors": 4, "events_clean": 18, "events_raw": 22}
    expected["ad_requests"] = 7
    tables = maintenance.FactTables(
        event_validation_errors=warehouse.scan("event_validation_errors"),
        events_clean=pipeline.events_clean,
        events_raw=warehouse.scan("events_raw"),
        ad_requests=warehouse.scan("ad_requests"),
    )
    counts = maintenance.survivor_counts(tables, scope).collect()
    assert {r["table_name"]: r["survivors"] for r in counts} == expected
    maintenance.purge_warehouse(warehouse, scope)
    assert pipeline.events_clean.count() == expected.pop("events_clean")
    for name, survivors in expected.items():
        assert warehouse.scan(name).count() == survivors
    assert warehouse.scan("events_validated").filter(scope.events()).isEmpty()
    assert warehouse.scan("events_raw").filter(scope.events()).isEmpty()


def test_purge_query_takes_rows_from_every_table(spark):
    folder = "/root/testdata/sf0.01"
    jobs = Jobs(spark, folder)
    left = catalog()["scoped_purge"](jobs).collect()
    for row in left:
        name = row["table_name"]
        whole = jobs.validation_errors if "errors" in name else getattr(jobs, name)
        assert 0 < row["survivors"] < whole.count(), name


def test_a_failed_rewrite_leaves_the_old_rows(spark, tmp_path, mixed):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.full_refresh("events_raw", mixed.raw)
    broken = F.raise_error("disk lost").cast("boolean")
    with pytest.raises(Exception, match="disk lost"):
        warehouse.delete_where("events_raw", broken)
    assert warehouse.read("events_raw").count() == 31
    warehouse.delete_where("events_raw", F.col("event_id") == "thrice")
    assert warehouse.read("events_raw").count() == 28


def test_only_the_last_two_versions_stay(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for n in range(1, 5):
        warehouse.full_refresh("numbers", spark.range(n))
    assert warehouse.versions("numbers") == [3, 4]
    assert warehouse.scan("numbers").count() == 4


def test_a_day_without_events_loses_its_metrics(spark, tmp_path):
    hand = seven_requests(spark)
    late = hand.request("trk_next_day", 4, at=datetime(2026, 6, 2, 9))
    hand.event(late, "impression")
    pipeline = pipeline_over(spark, tmp_path, hand)
    pipeline.validate()
    pipeline.refresh_daily_metrics()
    late_day = F.to_date("event_time") == F.lit(date(2026, 6, 2))
    pipeline.warehouse.delete_where("events_validated", late_day)
    pipeline.refresh_days([date(2026, 6, 1), date(2026, 6, 2)])
    daily = pipeline.warehouse.read("daily_campaign_metrics")
    assert {str(r["metric_date"]) for r in daily.collect()} == {"2026-06-01"}
    assert daily.agg(F.sum("impressions")).first()[0] == 9
    plan = plan_of(pipeline.clean_of_days([date(2026, 6, 2)]))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)


def test_a_rerun_without_faults_drops_the_old_errors(spark, tmp_path, mixed):
    pipeline_over(spark, tmp_path, mixed).validate()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        pipeline = pipeline_over(spark, tmp_path, seven_requests(spark))
        pipeline.validate()
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert pipeline.validated.count() == 22
    assert pipeline.warehouse.read("event_validation_errors").isEmpty()


def test_building_a_query_writes_nothing(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a query was written while it was built")

    monkeypatch.setattr(DataFrameWriter, "save", refuse)
    monkeypatch.setattr(DataFrameWriter, "parquet", refuse)
    for job in registered().values():
        job(spark, "/root/testdata/sf0.001")


def test_settings_of_the_caller_stay(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert tune(other).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_refresh_alerts_replaces_only_the_named_groups(spark):
    columns = "rule_group string, alert_message string"
    stored = spark.createDataFrame(
        [("data_quality", "kept"), ("generated_monitoring", "old")], columns
    )
    fresh = spark.createDataFrame([("generated_monitoring", "new")], columns)
    rows = alerting.refresh_alerts(stored, fresh, alerting.MONITORING_GROUPS).collect()
    assert {r["alert_message"] for r in rows} == {"kept", "new"}


def test_audit_finds_each_kind_of_violation(spark, mixed):
    requests = mixed.ad_requests.unionByName(
        mixed.ad_requests.filter(F.col("tracking_id") == "trk_hand_001")
    ).withColumn("platform", F.lit("windows"))
    report = audit.constraint_audit(
        {"ad_requests": requests, "campaigns": mixed.campaigns.filter("campaign_id <> 4")}
    )
    found = {
        (r["table_name"], r["constraint_kind"], r["column_name"]): r["violations"]
        for r in report.collect()
    }
    assert found["ad_requests", "primary_key", "ad_request_id"] == 1
    assert found["ad_requests", "unique", "tracking_id"] == 1
    assert found["ad_requests", "domain", "platform"] == 9
    assert found["ad_requests", "foreign_key", "campaign_id"] == 2
    assert found["ad_requests", "not_null", "country"] == 0
    assert ("ad_requests", "foreign_key", "user_id") not in found


def test_audit_counts_long_texts_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "A" * 101, "DE"), (2, "ok", "DEU"), (None, None, None)],
        "publisher_id long, publisher_name string, country string",
    )
    report = audit.constraint_audit({"publishers": df}).collect()
    found = {(r["constraint_kind"], r["column_name"]): r["violations"] for r in report}
    assert found["max_length", "publisher_name"] == 1
    assert found["max_length", "country"] == 1
    assert found["not_null", "publisher_id"] == 1


def test_declared_schemas_fit_what_the_jobs_store(spark, tmp_path, mixed):
    warehouse = Warehouse(spark, str(tmp_path))
    daily = reporting.daily_app_metrics(mixed.raw.filter("app_id is not null"))
    warehouse.full_refresh("daily_app_metrics", daily)
    stored = warehouse.read("daily_app_metrics")
    assert stored.count() == daily.count()
    assert set(stored.columns) == set(daily.columns)


def test_insert_fills_columns_that_are_left_out(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [(1, "e1", "click", None)],
        "raw_event_id int, event_id string, event_type string, reward_cost decimal(10,2)",
    )
    warehouse.insert("events_raw", rows.withColumn("event_time", F.lit(datetime(2026, 6, 1))))
    row = warehouse.read("events_raw").first()
    assert (row["revenue"], row["reward_cost"]) == (0, None)
    assert row["tracking_id"] is None and row["created_at"] is not None
