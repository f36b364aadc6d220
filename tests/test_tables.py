"""Versions, manifests and concurrent writers of the stored tables."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from hand_rows import plan_of
from pyspark.sql import functions as F

from clickstrata.operators import maintenance
from clickstrata.sources import tables
from clickstrata.sources.tables import CommitConflict, File, KeyRange, Warehouse

EVENT = "raw_event_id long, event_id string, tracking_id string"
LOADS = ("alpha", "beta", "gamma")


def load(spark, prefix, first, n=20):
    rows = [(first + i, f"evt_{prefix}_{i}", f"trk_{prefix}_{i % 5}") for i in range(n)]
    return spark.createDataFrame(rows, EVENT).coalesce(1)


@pytest.fixture
def three_loads(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "a warehouse+100%"))
    for i, prefix in enumerate(LOADS):
        warehouse.append("events_raw", load(spark, prefix, 100 * i))
    return warehouse


def ids(warehouse, name="events_raw"):
    return sorted(r["raw_event_id"] for r in warehouse.scan(name).collect())


def daily(spark, values):
    rows = [(date(2026, 6, d), n) for d, n in values]
    return spark.createDataFrame(rows, "metric_date date, impressions long")


def impressions(df):
    return {(r["metric_date"].day, r["impressions"]) for r in df.collect()}


def scanned_files(df):
    return len({Path(path).name for path in df.inputFiles()})


# --- deletes ------------------------------------------------------------------


def test_purge_of_a_prefix_reads_and_rewrites_one_file(spark, three_loads):
    warehouse = three_loads
    scope = maintenance.Scope("evt_beta_", "trk_beta_")
    before = warehouse.files("events_raw")
    assert scanned_files(warehouse.scan("events_raw", scope.event_ranges())) == 1
    warehouse.delete_where("events_raw", scope.events(), scope.event_ranges())
    after = warehouse.files("events_raw")
    # All rows of the file are doomed: it leaves and nothing is written.
    assert len(after) == 2 and set(after) < set(before)
    assert ids(warehouse) == [*range(20), *range(200, 220)]


def test_a_delete_rewrites_only_files_that_hold_doomed_rows(spark, three_loads):
    warehouse = three_loads
    before = warehouse.files("events_raw")
    warehouse.delete_where("events_raw", F.col("raw_event_id").between(205, 207))
    after = warehouse.files("events_raw")
    assert len(set(before) & set(after)) == 2 and len(after) == 3
    assert ids(warehouse) == [*range(20), *range(100, 120), *range(200, 205), *range(208, 220)]
    keys = spark.createDataFrame([(3,), (3,), (None,), (999,)], "raw_event_id long")
    warehouse.delete_joined("events_raw", keys, "raw_event_id")
    assert len(set(warehouse.files("events_raw")) & set(after)) == 2
    assert 3 not in ids(warehouse) and len(ids(warehouse)) == 56


def test_a_delete_that_hits_nothing_makes_no_version(spark, three_loads):
    before = three_loads.versions("events_raw")
    three_loads.delete_where("events_raw", F.col("raw_event_id") > 10_000)
    three_loads.delete_where("events_raw", F.lit(True), [KeyRange("raw_event_id", 10_000)])
    assert three_loads.versions("events_raw") == before


def test_deleting_everything_leaves_an_empty_table(spark, three_loads):
    three_loads.delete_where("events_raw", F.lit(True))
    assert three_loads.files("events_raw") == [] and ids(three_loads) == []
    assert three_loads.scan("events_raw").columns == ["raw_event_id", "event_id", "tracking_id"]
    three_loads.append("events_raw", load(spark, "delta", 5, 1))
    assert ids(three_loads) == [5]


def test_prefix_ranges_hold_every_text_with_the_prefix():
    def file(least, most):
        return File("p", 1, 1, {"event_id": (least, most)})

    for prefix in ("evt_", "a\uffff", "é", "z\ud7ff", "q\U0010ffff", "\U0010ffff"):
        texts = [prefix, prefix + "\U0010ffff", prefix + "a", prefix[:-1], prefix[:-1] + " "]
        kept = {t for t in texts if KeyRange.of_prefix("event_id", prefix).may_be_in(file(t, t))}
        assert {t for t in texts if t.startswith(prefix)} <= kept
    assert not KeyRange.of_prefix("event_id", "e").may_be_in(file(None, None))
    assert not KeyRange.of_prefix("event_id", "b").may_be_in(file("c", "d"))
    assert KeyRange.of_prefix("tracking_id", "b").may_be_in(file("c", "d"))


def test_old_files_go_with_the_versions_that_need_them(spark, three_loads, tmp_path):
    warehouse = three_loads
    for doomed in (1, 101, 201, 2):
        warehouse.delete_where("events_raw", F.col("raw_event_id") == doomed)
    root = Path(warehouse.root) / "events_raw"
    kept = {str(p.relative_to(root / "data")) for p in (root / "data").rglob("*.parquet")}
    assert set(warehouse.files("events_raw")) <= kept and len(kept) == 4
    assert len(warehouse.versions("events_raw")) == 2


def test_batches_of_failed_writes_are_swept_by_age(spark, three_loads):
    lost = "_batch=0123"
    load(spark, "lost", 900).write.parquet(f"{three_loads.root}/events_raw/data/{lost}")
    assert three_loads.sweep("events_raw") == []
    assert len(ids(three_loads)) == 60
    assert three_loads.sweep("events_raw", older_than_hours=0) == [lost]
    assert len(ids(three_loads)) == 60


# --- days ---------------------------------------------------------------------


def test_a_failed_day_refresh_leaves_the_old_days(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.full_refresh("daily_app_metrics", daily(spark, [(1, 10), (2, 20), (3, 30)]))
    before = warehouse.versions("daily_app_metrics")
    broken = daily(spark, [(2, 21), (3, 31)]).withColumn(
        "impressions",
        F.when(F.col("impressions") == 31, F.raise_error("disk lost").cast("long")).otherwise(
            F.col("impressions")
        ),
    )
    with pytest.raises(Exception, match="disk lost"):
        warehouse.refresh_days("daily_app_metrics", broken, [date(2026, 6, 2), date(2026, 6, 3)])
    assert warehouse.versions("daily_app_metrics") == before
    assert impressions(warehouse.scan("daily_app_metrics")) == {(1, 10), (2, 20), (3, 30)}


def test_a_reader_that_has_planned_finishes_on_its_version(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.full_refresh("daily_app_metrics", daily(spark, [(1, 10), (2, 20)]))
    reader = warehouse.scan("daily_app_metrics")
    warehouse.refresh_days("daily_app_metrics", daily(spark, [(2, 21)]), [date(2026, 6, 2)])
    assert impressions(reader) == {(1, 10), (2, 20)}
    assert impressions(warehouse.scan("daily_app_metrics")) == {(1, 10), (2, 21)}


def test_day_refresh_may_read_the_table_it_changes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.full_refresh("daily_app_metrics", daily(spark, [(1, 10), (2, 20)]))
    more = warehouse.scan("daily_app_metrics").withColumn("impressions", F.col("impressions") + 1)
    warehouse.refresh_days("daily_app_metrics", more, [date(2026, 6, 2), date(2026, 6, 9)])
    assert impressions(warehouse.scan("daily_app_metrics")) == {(1, 10), (2, 21)}
    plan = plan_of(warehouse.scan("daily_app_metrics").filter(F.col("metric_date") == date(2026, 6, 2)))
    assert "PartitionFilters: [isnotnull(metric_date" in plan


# --- writers that meet --------------------------------------------------------


def meanwhile(monkeypatch, warehouse, act, times=1):
    """Let another writer commit just before this one takes its version number."""
    put, left = Warehouse._put_if_absent, [times]

    def interrupted(self, path, content):
        if left[0]:
            left[0] -= 1
            act(left[0])
        return put(self, path, content)

    monkeypatch.setattr(Warehouse, "_put_if_absent", interrupted)


def test_two_appends_at_once_both_stay(spark, three_loads, monkeypatch):
    other = Warehouse(spark, three_loads.root)
    meanwhile(
        monkeypatch, three_loads, lambda n: other.append("events_raw", load(spark, "o", 500 + n, 1)), 2
    )
    three_loads.append("events_raw", load(spark, "delta", 300, 2))
    assert ids(three_loads)[60:] == [300, 301, 500, 501]


def test_a_delete_also_takes_rows_that_arrive_meanwhile(spark, three_loads, monkeypatch):
    other = Warehouse(spark, three_loads.root)
    meanwhile(monkeypatch, three_loads, lambda _: other.append("events_raw", load(spark, "beta", 400)))
    scope = maintenance.Scope("evt_beta_", "trk_beta_")
    three_loads.delete_where("events_raw", scope.events(), scope.event_ranges())
    assert ids(three_loads) == [*range(20), *range(200, 220)]


def test_two_deletes_at_once_both_hold(spark, three_loads, monkeypatch):
    other = Warehouse(spark, three_loads.root)
    key = F.col("raw_event_id")
    meanwhile(monkeypatch, three_loads, lambda _: other.delete_where("events_raw", key == 7))
    three_loads.delete_where("events_raw", key == 8)
    assert ids(three_loads) == [n for n in (*range(20), *range(100, 120), *range(200, 220)) if n not in (7, 8)]


def test_a_mark_is_taken_once(spark, three_loads):
    path = f"{three_loads.root}/events_raw/_committed/00000009"
    assert three_loads._put_if_absent(path, "first")
    assert not three_loads._put_if_absent(path, "second")
    assert three_loads._content(path) == "first"


def test_a_writer_that_never_gets_its_turn_says_so(spark, three_loads, monkeypatch):
    monkeypatch.setattr(tables, "_ATTEMPTS", 2)
    monkeypatch.setattr(Warehouse, "_put_if_absent", lambda *_: False)
    with pytest.raises(CommitConflict):
        three_loads.append("events_raw", load(spark, "delta", 300))
    assert len(ids(three_loads)) == 60


# --- landing ------------------------------------------------------------------


def test_a_crash_between_rows_and_commit_lands_the_batch_once(spark, three_loads, monkeypatch):
    batch = load(spark, "landed", 700, 3)
    commit = Warehouse._put_if_absent

    def crash(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(Warehouse, "_put_if_absent", crash)
    with pytest.raises(OSError, match="driver lost"):
        three_loads.land("events_raw", batch, "feed-0")
    monkeypatch.setattr(Warehouse, "_put_if_absent", commit)
    three_loads.delete_where("events_raw", F.col("raw_event_id") == 0)
    three_loads.land("events_raw", batch, "feed-0")
    three_loads.delete_where("events_raw", F.col("raw_event_id") == 701)
    three_loads.land("events_raw", batch, "feed-0")
    assert ids(three_loads)[59:] == [700, 702]


def test_a_batch_that_two_streams_land_at_once_is_there_once(spark, three_loads, monkeypatch):
    other, batch = Warehouse(spark, three_loads.root), load(spark, "landed", 700, 3)
    meanwhile(monkeypatch, three_loads, lambda _: other.land("events_raw", batch, "feed-0"))
    three_loads.land("events_raw", batch, "feed-0")
    assert ids(three_loads)[60:] == [700, 701, 702]
    three_loads.full_refresh("events_raw", load(spark, "new", 1, 2))
    three_loads.land("events_raw", batch, "feed-0")
    assert ids(three_loads) == [1, 2]


def test_an_appended_column_is_null_in_older_rows(spark, three_loads):
    more = load(spark, "wide", 300, 1).withColumn("country", F.lit("DE"))
    three_loads.append("events_raw", more.withColumn("raw_event_id", F.col("raw_event_id").cast("int")))
    rows = {r["raw_event_id"]: r["country"] for r in three_loads.scan("events_raw").collect()}
    assert rows[300] == "DE" and rows[0] is None and len(rows) == 61
