from __future__ import annotations

from hand_rows import seven_requests, with_faults
from pyspark.sql import functions as F

from clickstrata.plans.pipeline import Inputs, Pipeline
from clickstrata.sources.tables import Warehouse
from clickstrata.streaming.landing import arriving_events, land_events


def test_files_land_once_and_the_batch_follows(spark, tmp_path):
    hand = with_faults(seven_requests(spark))
    incoming = str(tmp_path / "incoming")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))

    def land():
        stream = arriving_events(spark, incoming)
        land_events(stream, warehouse, str(tmp_path / "progress")).awaitTermination()
        return warehouse.read("events_raw")

    early, late = hand.raw.filter("raw_event_id <= 26"), hand.raw.filter("raw_event_id > 26")
    early.write.parquet(incoming)
    assert land().count() == 26
    assert land().count() == 26
    late.write.mode("append").parquet(incoming)
    raw = land()
    assert raw.count() == 31

    inputs = Inputs(raw, hand.ad_requests, hand.campaigns, hand.experiments)
    pipeline = Pipeline(warehouse, inputs)
    pipeline.validate()
    # The first copy of the duplicate landed a run earlier and is rejected too.
    assert pipeline.events_clean.count() == 23


def test_landing_tolerates_appends_and_deletes(spark, tmp_path):
    hand = with_faults(seven_requests(spark))
    incoming = str(tmp_path / "incoming")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))

    def land():
        stream = arriving_events(spark, incoming)
        land_events(stream, warehouse, str(tmp_path / "progress")).awaitTermination()
        return sorted(r["raw_event_id"] for r in warehouse.read("events_raw").collect())

    hand.raw.filter("raw_event_id <= 10").write.parquet(incoming)
    assert land() == list(range(1, 11))
    warehouse.append("events_raw", hand.raw.filter("raw_event_id = 31"))
    warehouse.delete_where("events_raw", F.col("raw_event_id") == 5)
    hand.raw.filter("raw_event_id between 11 and 20").write.mode("append").parquet(incoming)
    expected = [n for n in (*range(1, 21), 31) if n != 5]
    assert land() == expected
    # A batch that is repeated after it was completed adds nothing.
    warehouse.land("events_raw", hand.raw.filter("raw_event_id <= 10"), "events-0")
    assert land() == expected
