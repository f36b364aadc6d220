"""Landing arriving event files in the raw table.

Raw events are appended as they come, without any check: the batch validation
needs the whole table, because a later copy of an event id also rejects the
earlier one.  The stream therefore only takes over the inserts, and the batch
pipeline runs when it pauses.  Each micro-batch is landed under its number, so a
batch repeated after a failure adds nothing, and the table stays an ordinary one
that appends and deletes may change between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickstrata.schemas import TABLES
from clickstrata.sources.tables import Warehouse


def arriving_events(
    spark: SparkSession, folder: str, file_format: str = "parquet"
) -> DataFrame:
    """Event files of a folder as a stream with the declared raw schema."""
    schema = TABLES["events_raw"].schema
    return spark.readStream.format(file_format).schema(schema).load(folder)


def land_events(
    events: DataFrame, warehouse: Warehouse, checkpoint: str, feed: str = "events"
) -> StreamingQuery:
    """Append everything that has arrived so far, then stop.

    ``availableNow`` keeps the progress between runs, so calling this on a
    schedule lands each file once, and splits a backlog into several batches.
    ``feed`` tells streams with checkpoints of their own apart.
    """

    def land(batch: DataFrame, number: int) -> None:
        warehouse.land("events_raw", batch, f"{feed}-{number}")

    return (
        events.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
