"""Batch by batch against one run over everything."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta
from functools import reduce

import pytest
from hand_rows import plan_of, seven_requests, with_faults
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.operators import incremental, maintenance, reporting, validation
from clickstrata.plans.pipeline import COPIES, VALIDATED, Inputs, Pipeline
from clickstrata.sources.tables import Warehouse

TABLES = (VALIDATED, "event_validation_errors", "daily_campaign_metrics", "daily_app_metrics")


def story(spark):
    """Faulty events over four days, copies days apart, and a request that is late."""
    hand = with_faults(seven_requests(spark))
    by_id = {row["tracking_id"]: row for row in hand.requests}
    for day, (name, kind, event_id) in enumerate(
        [
            ("trk_hand_001", "click", "hand_1"),
            ("trk_hand_002", "impression", "far_apart"),
            ("trk_hand_003", "click", "thrice"),
            ("trk_hand_002", "impression", "far_apart"),
            ("trk_hand_006", "click", "hand_20"),
            ("trk_hand_007", "click", "plain_1"),
            ("trk_hand_007", "click", "plain_2"),
        ]
    ):
        row = hand.event(by_id[name], kind, event_id=event_id)
        row["event_time"] += timedelta(days=day % 4)
    late = hand.request("trk_late", 5, app_id=25, user_id=9, country="US")
    row = hand.event(late, "impression")
    row["event_time"] += timedelta(days=1)
    hand.event(late, "click", country="NO")["event_time"] += timedelta(days=2)
    return hand


def rows_of(pipeline, name):
    df = pipeline.warehouse.scan(name)
    columns = sorted(set(df.columns) - {"detected_at"})
    rows = [r.asDict(recursive=True) for r in df.select(*columns).collect()]
    for row in rows:
        if row.get("errors"):
            row["errors"] = sorted(map(str, row["errors"]))
    return Counter(str(sorted(row.items(), key=str)) for row in rows)


def over(spark, root, hand, requests=None):
    inputs = Inputs(hand.raw, requests or hand.ad_requests, hand.campaigns, hand.experiments)
    return Pipeline(Warehouse(spark, str(root)), inputs)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    hand = story(spark)
    pipeline = over(spark, tmp_path_factory.mktemp("whole"), hand)
    pipeline.validate()
    pipeline.refresh_daily_metrics()
    return hand, {name: rows_of(pipeline, name) for name in TABLES}


def test_batch_by_batch_equals_one_run(spark, tmp_path, whole):
    hand, expected = whole
    raw, requests = hand.raw, hand.ad_requests
    early = requests.filter("tracking_id <> 'trk_late'")
    pipeline = over(spark, tmp_path, hand, early)
    days = []
    for n, (first, last) in enumerate([(1, 20), (21, 29), (30, 34), (35, 99)]):
        batch = raw.filter(F.col("raw_event_id").between(first, last))
        days.append(pipeline.take_in(batch, f"batch-{n}"))
    # A batch that is repeated adds nothing.
    assert pipeline.take_in(batch, "batch-3") == []
    pipeline = over(spark, tmp_path, hand)
    late = requests.filter("tracking_id = 'trk_late'")
    days.append(pipeline.take_in(raw.limit(0), "late", late))
    assert days[0] == [date(2026, 6, 1)]
    assert days[-1] == [date(2026, 6, 2), date(2026, 6, 3)]
    for name in TABLES:
        assert rows_of(pipeline, name) == expected[name], name
    copies = pipeline.warehouse.scan(COPIES).groupBy("event_id").agg(F.sum("copies").alias("n"))
    counted = raw.filter("event_id is not null").groupBy("event_id").count()
    assert Counter(map(tuple, copies.collect())) == Counter(map(tuple, counted.collect()))


def test_a_late_copy_rewrites_only_the_day_it_spoils(spark, tmp_path, whole):
    hand, _ = whole
    pipeline = over(spark, tmp_path, hand)
    pipeline.take_in(hand.raw.filter("raw_event_id < 34"), "first")
    before = {path for path in pipeline.warehouse.files(VALIDATED)}
    # Event hand_1 lies on the first day; its copy arrives with later ones.
    spoiling = hand.raw.filter("raw_event_id = 38").withColumn("event_id", F.lit("hand_2"))
    days = pipeline.take_in(spoiling, "second")
    gone = before - set(pipeline.warehouse.files(VALIDATED))
    assert days[0] == date(2026, 6, 1) and len(days) == 2
    assert gone and all("event_date=2026-06-01" in path for path in gone)
    assert all("is_clean=true" in path for path in gone)
    errors = pipeline.warehouse.read("event_validation_errors").filter("event_id = 'hand_2'")
    assert {r["error_type"] for r in errors.collect()} == {"duplicate_event_id"}
    assert errors.count() == 2


def test_only_the_buckets_of_the_new_ids_are_read(spark, tmp_path, whole):
    hand, _ = whole
    pipeline = over(spark, tmp_path, hand)
    pipeline.take_in(hand.raw, "first")
    arrived = incremental.copies_of(hand.raw.filter("raw_event_id = 1"))
    plan = plan_of(incremental.seen_before(pipeline.warehouse.scan(COPIES), arrived))
    (bucket,) = [r["id_bucket"] for r in arrived.collect()]
    assert f"(id_bucket#" in plan and f" = {bucket})" in plan.split("PartitionFilters: ")[1]


def test_tables_that_missed_a_batch_are_computed_again(spark, tmp_path, whole, monkeypatch):
    hand, expected = whole
    pipeline = over(spark, tmp_path, hand)
    pipeline.take_in(hand.raw.filter("raw_event_id <= 28"), "first")
    append = Warehouse.append

    def crash(*_, **__):
        raise OSError("driver lost")

    rest = hand.raw.filter("raw_event_id > 28")
    monkeypatch.setattr(Warehouse, "append", crash)
    with pytest.raises(OSError, match="driver lost"):
        pipeline.take_in(rest, "second")
    monkeypatch.setattr(Warehouse, "append", append)
    assert pipeline.take_in(rest, "second") == []
    for name in TABLES:
        assert rows_of(pipeline, name) == expected[name], name
    # A full run in between makes the counts of ids stale; they follow it.
    pipeline.validate()
    copy = hand.raw.filter("raw_event_id = 2").withColumn("raw_event_id", F.lit(900))
    pipeline.take_in(copy, "third")
    errors = pipeline.warehouse.read("event_validation_errors")
    assert errors.filter("event_id = 'hand_2'").count() == 2


def test_a_purge_refreshes_the_days_it_touches(spark, tmp_path, whole):
    hand, _ = whole
    pipeline = over(spark, tmp_path / "purged", hand)
    pipeline.take_in(hand.raw, "all")
    for name in ("events_raw", "ad_requests"):
        pipeline.warehouse.full_refresh(name, getattr(hand, name.removeprefix("events_")))
    days = pipeline.purge(maintenance.Scope("thrice", "trk_hand_003"))
    assert date(2026, 6, 1) in days
    left = hand.raw.filter(
        "coalesce(event_id not like 'thrice%', true) and coalesce(tracking_id not like 'trk_hand_003%', true)"
    )
    inputs = Inputs(left, hand.ad_requests, hand.campaigns, hand.experiments)
    fresh = Pipeline(Warehouse(spark, str(tmp_path / "fresh")), inputs)
    fresh.validate()
    fresh.refresh_daily_metrics()
    for name in ("daily_campaign_metrics", "daily_app_metrics"):
        assert rows_of(pipeline, name) == rows_of(fresh, name), name


def test_sums_with_events_taken_off_equal_a_recount(spark):
    hand = story(spark)
    classified = validation.classify_events(hand.raw, hand.ad_requests)
    classified = classified.filter("errors is null").persist()
    plus, minus = (F.lit(n).cast("long") for n in (1, -1))

    def clean_where(condition):
        return validation.clean_of(classified.filter(condition))

    # Among those taken off are all events of some days and keys.
    gone = "(raw_event_id % 3 = 0 or raw_event_id between 5 and 12)"
    clean, left = clean_where("true"), clean_where(f"not {gone}")
    parts = [
        [(clean_where("raw_event_id < 25"), plus)],
        [
            (clean_where("raw_event_id >= 25"), plus),
            (clean_where(f"raw_event_id < 25 and {gone}"), minus),
        ],
        [(clean_where(f"raw_event_id >= 25 and {gone}"), minus)],
    ]

    def summed(key):
        batches = []
        for changes in parts:
            signed = [rows.withColumn("sign", sign) for rows, sign in changes]
            batches.append(reporting.daily_sums(reduce(DataFrame.unionByName, signed), key))
        return reduce(DataFrame.unionByName, batches)

    def rows(df):
        return Counter(map(tuple, df.collect()))

    by_campaign = reporting.daily_campaign_of_sums(summed("campaign_id"), hand.campaigns)
    recount = reporting.daily_campaign_metrics(left, hand.campaigns)
    assert rows(by_campaign) == rows(recount) and by_campaign.columns == recount.columns
    by_app, recount = reporting.daily_app_of_sums(summed("app_id")), reporting.daily_app_metrics(left)
    assert rows(by_app) == rows(recount) and by_app.columns == recount.columns
    assert 0 < recount.count() < reporting.daily_app_metrics(clean).count()
    # Nothing left, and nothing there from the start.
    everything = [clean.withColumn("sign", sign) for sign in (plus, minus)]
    assert not reporting.daily_app_of_sums(
        reporting.daily_sums(everything[0].unionByName(everything[1]), "app_id")
    ).count()
    assert not reporting.daily_app_of_sums(
        reporting.daily_sums(everything[0].limit(0), "app_id")
    ).count()


def test_a_batch_reads_no_other_events_of_the_days_it_changes(spark, tmp_path, monkeypatch):
    hand = story(spark)
    pipeline = over(spark, tmp_path, hand)
    pipeline.take_in(hand.raw.filter("raw_event_id < 25"), "first")
    before = pipeline.warehouse.files("daily_campaign_sums")

    def read(*_):
        raise AssertionError("clean events read again")

    monkeypatch.setattr(Pipeline, "events_clean", property(read))
    monkeypatch.setattr(Pipeline, "clean_of_days", read)
    assert pipeline.take_in(hand.raw.filter("raw_event_id >= 25"), "second")
    monkeypatch.undo()
    # What earlier batches added stays as it is; a full refresh merges it.
    assert set(before) < set(pipeline.warehouse.files("daily_campaign_sums"))
    found = {name: rows_of(pipeline, name) for name in TABLES[2:]}
    pipeline.refresh_daily_metrics()
    assert found == {name: rows_of(pipeline, name) for name in TABLES[2:]}
    sums = pipeline.warehouse.scan("daily_campaign_sums")
    assert sums.count() == sums.select("metric_date", "campaign_id").distinct().count()
