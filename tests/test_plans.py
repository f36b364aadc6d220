"""What the plans must and must not contain, and how they take skew."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from hand_rows import plan_of
from pyspark.sql import functions as F

from clickstrata.operators import audit, experiments, quality_alerts, reporting, validation
from clickstrata.plans.jobs import Jobs
from clickstrata.schemas import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived facts as Parquet, as a warehouse would hold them."""
    root = tmp_path_factory.mktemp("facts")
    jobs = Jobs(spark, FOLDER)
    frames = {}
    for name in ("events_raw", "ad_requests"):
        path = str(root / name)
        getattr(jobs, name).write.parquet(path)
        frames[name] = spark.read.parquet(path)
    frames["campaigns"] = jobs.campaigns
    return frames


def test_scope_and_columns_reach_the_scan(stored):
    plan = plan_of(
        reporting.campaign_kpi(stored["events_raw"], stored["campaigns"], "trk_py_")
    )
    assert "StringStartsWith(tracking_id,trk_py_)" in plan
    read = plan.split("FileScan parquet [")[1].split("]")[0]
    assert {column.split("#")[0] for column in read.split(",")} == {
        "tracking_id",
        "campaign_id",
        "event_type",
        "revenue",
        "reward_cost",
    }


def test_funnel_rules_read_only_the_event_types_they_compare(stored):
    plan = plan_of(quality_alerts.duplicate_installs(stored["events_raw"]))
    assert "EqualTo(event_type,install)" in plan


def test_validation_reads_raw_events_once_whole_and_once_for_their_ids(spark, stored):
    raw, requests = stored["events_raw"], stored["ad_requests"]
    duplicates = validation.duplicate_event_ids(raw)
    plan = plan_of(validation.validation_errors(raw, requests, duplicates))
    scans = [
        {column.split("#")[0] for column in scan.split("]")[0].split(",")}
        for scan in plan.split("FileScan parquet [")[1:]
        if "/events_raw]" in scan.split("ReadSchema")[0]
    ]
    narrow, wide = sorted(scans, key=len)
    assert narrow == {"event_id"} and len(wide) > 5
    assert plan.count("FileScan parquet") == 3


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts and tiny skew limits, to see the plan of a large input."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


ROWS = 60_000


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of the events on one request, a third without any, and one
    event id shared by a third of all rows."""
    n = F.col("id")
    raw = spark.range(ROWS).select(
        n.alias("raw_event_id"),
        F.when(n % 3 == 2, F.lit("same")).otherwise(F.concat(F.lit("e"), n)).alias("event_id"),
        F.when(n % 3 == 0, F.lit("hot"))
        .when(n % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("t"), n % 1000))
        .alias("tracking_id"),
        F.lit(1).cast("long").alias("campaign_id"),
        (n % 2).alias("app_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.when(n % 2 == 0, "impression").otherwise("click").alias("event_type"),
        F.lit(datetime(2026, 6, 1)).cast("timestamp_ntz").alias("event_time"),
        F.lit("1.00").cast("decimal(10,2)").alias("revenue"),
        F.lit("0.00").cast("decimal(10,2)").alias("reward_cost"),
        F.lit("DE").alias("country"),
        F.lit("ios").alias("platform"),
    )
    ids = ["hot", *(f"t{i}" for i in range(0, 1000, 2))]
    rows = [
        (i, key, 1, 0, 1, 1, datetime(2026, 6, 1), "DE", "ios")
        for i, key in enumerate(ids)
    ]
    requests = spark.createDataFrame(rows, TABLES["ad_requests"].schema)
    return raw, requests


def expected_errors():
    """Brute force over the same arithmetic."""
    found = Counter()
    for n in range(ROWS):
        third = n % 3
        if third == 2:
            found["duplicate_event_id"] += 1
        if third == 1:
            found["missing_tracking_id"] += 1
        elif third == 2 and n % 1000 % 2 == 1:
            found["unknown_tracking_id"] += 1
        elif n % 2 == 1:
            found["app_mismatch"] += 1
    return found


def test_hot_keys_and_nulls_give_whole_results(spark, lopsided, shuffled_joins):
    raw, requests = lopsided
    errors = validation.validation_errors(raw, requests)
    counted = {
        r["error_type"]: r["count"]
        for r in errors.groupBy("error_type").count().collect()
    }
    assert counted == expected_errors()
    clean = validation.events_clean(raw, requests)
    assert clean.count() == sum(1 for n in range(ROWS) if n % 3 == 0 and n % 2 == 0)
    lost = quality_alerts.missing_or_unknown_tracking(raw, requests)
    assert lost.count() == sum(
        1 for n in range(ROWS) if n % 3 == 1 or (n % 3 == 2 and n % 1000 % 2 == 1)
    )


def test_missing_ids_spread_over_all_tasks(spark, lopsided, shuffled_joins):
    raw, requests = lopsided
    missing = raw.filter(F.col("tracking_id").isNull())
    met = validation.meet_requests(missing, requests, "left", "app_id")
    sizes = [
        r["count"]
        for r in met.groupBy(F.spark_partition_id().alias("task")).count().collect()
    ]
    assert sum(sizes) == ROWS // 3
    assert max(sizes) < 2 * ROWS // 3 / len(sizes)


def test_adaptive_execution_splits_the_hot_request(spark, lopsided, shuffled_joins):
    raw, requests = lopsided
    met = validation.meet_requests(raw, requests, "left", *validation.MISMATCHES)
    met.write.format("noop").mode("overwrite").save()
    collected = met.select("raw_event_id", "request_app_id")
    collected.collect()
    assert "isSkew=true" in plan_of(collected) or "skewed" in plan_of(collected)


def test_hot_request_is_summed_before_the_experiment_join(spark, lopsided):
    raw, requests = lopsided
    jobs = Jobs(spark, FOLDER)
    plan = plan_of(
        experiments.experiment_results(requests, raw, jobs.experiments, jobs.campaigns)
    )
    assert "partial_count" in plan
    result = experiments.experiment_results(
        requests, raw, jobs.experiments, jobs.campaigns
    ).first()
    served = sum(1 for n in range(ROWS) if n % 3 == 0 or (n % 3 == 2 and n % 1000 % 2 == 0))
    assert result["impressions"] + result["clicks"] == served
    assert result["ad_requests"] == 501


def test_the_audit_scans_each_table_once_and_counts_all_keys_at_once(spark, stored):
    tables = {"ad_requests": stored["ad_requests"], "campaigns": stored["campaigns"]}
    tables["events_raw"] = stored["events_raw"]
    plan = plan_of(audit.constraint_audit(tables))
    assert plan.count("/events_raw]") == 1 and plan.count("/ad_requests]") == 1
    assert plan.count("hashpartitioning(subject") == 1


def test_keys_of_several_columns_and_nulls_stay_apart(spark):
    rows = spark.createDataFrame(
        [("a:1", "b"), ("a", "1:b"), ("a", None), ("a", ""), ("a", None)], "x string, y string"
    )
    assert rows.select(audit._text(("x", "y"))).distinct().count() == 4


def test_clean_events_and_alerts_shuffle_no_event_by_its_id(spark, stored, shuffled_joins):
    """Nothing but hashes, and the events in the slots of repeated ids."""
    schema = "raw_event_id string, event_id string, tracking_id string"
    rows = [(str(i), f"e{i if i % 50 else 0}", f"t{i}") for i in range(2000)]
    rows += [(f"n{i}", None, f"t{i}") for i in range(2000, 2040)]
    raw = spark.createDataFrame(rows, schema)
    assert validation.maybe_repeated(raw).count() < 120  # 40 copies, 40 nulls
    for ids in (validation.repeated_event_ids(raw), validation.duplicate_event_ids(raw)):
        assert sorted(r.event_id or "" for r in ids.collect()) == ["", "e0"]
    requests = stored["ad_requests"]
    clean = plan_of(validation.events_clean(stored["events_raw"], requests))
    alerts = plan_of(
        quality_alerts.quality_alerts(stored["events_raw"], requests, stored["campaigns"])
    )
    errors = plan_of(validation.validation_errors(stored["events_raw"], requests))
    for plan in (clean, alerts, errors):
        by_id = plan.split("Exchange hashpartitioning(event_id")[1:]
        assert by_id and all("LeftSemi" in x for x in by_id)
