"""Validating new events against what earlier batches left behind.

An event id that occurs more than once rejects all its rows, so a late copy also
rejects a row that was clean so far.  The state for that is how often each id was
seen and, for an id seen once, on which day its row lies.  New batches add their
own counts; nothing of it is rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.operators import validation

BUCKETS = 16


def bucket_of(event_id: str = "event_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int")


def copies_of(events: DataFrame) -> DataFrame:
    """(event_id, copies, event_date, id_bucket): a batch's part of the state.

    Ids that are missing repeat nothing.  The day is only of use for a single copy.
    """
    day = F.col("event_date") if "event_date" in events.columns else F.to_date("event_time")
    return (
        events.filter(F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(day).alias("event_date"))
        .withColumn("id_bucket", bucket_of())
    )


def seen_before(state: DataFrame, arrived: DataFrame) -> DataFrame:
    """(event_id, copies, event_date) of the arrived ids that the state knows.

    Only the buckets of the arrived ids are read, a partition filter.
    """
    rows = arrived.select("id_bucket").distinct().collect()  # at most BUCKETS
    touched = [row["id_bucket"] for row in rows]
    known = state.filter(F.col("id_bucket").isin(*touched)) if touched else state.limit(0)
    return (
        known.join(arrived.select("event_id"), "event_id", "left_semi")
        .groupBy("event_id")
        .agg(F.sum("copies").alias("copies"), F.min("event_date").alias("event_date"))
    )


def spoiled_by(seen: DataFrame) -> DataFrame:
    """Ids whose only earlier row did not count as a duplicate until now."""
    return seen.filter(F.col("copies") == 1).select("event_id", "event_date")


def repeated_in(arrived: DataFrame, seen: DataFrame) -> DataFrame:
    """Ids of the batch of which there is more than one copy by now."""
    often = arrived.filter(F.col("copies") > 1).select("event_id")
    return often.union(seen.select("event_id")).distinct()


def was_duplicate() -> Column:
    """Whether a stored row already carries the duplicate error."""
    return F.coalesce(
        F.exists("errors", lambda e: e["error_type"] == "duplicate_event_id"), F.lit(False)
    )


def classified_again(
    rows: DataFrame, spoiled: DataFrame, requests: DataFrame, columns: list[str]
) -> DataFrame:
    """Stored rows under all rules anew, knowing which ids repeat by now."""
    known = rows.filter(was_duplicate()).select("event_id")
    repeated = known.union(spoiled.select("event_id")).distinct()
    return validation.classify_events(rows.select(*columns), requests, repeated)


def clean_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Clean events that came (sign 1) and went (sign -1) with a classification."""
    gone = validation.clean_of(before).withColumn("sign", F.lit(-1).cast("long"))
    come = validation.clean_of(after).withColumn("sign", F.lit(1).cast("long"))
    return come.unionByName(gone)
