"""Splitting raw events into clean rows and typed validation errors.

Eight rules, one pass: duplicate event ids are found by a narrow aggregate,
every event meets its ad request in one join on ``tracking_id``, and the rules
are conditions over that row.  Every event breaks some rule or none, so rejected
and clean rows always add up to raw.

Asked for on their own, single rules and the clean table run leaner plans that
read only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.rules import Rule, any_hit, emit, hits
from clickstrata.functions.text import message

ERROR_KEYS = ("raw_event_id", "event_id", "tracking_id")

# Event columns that must repeat the ad request's value, with the error type.
MISMATCHES = {
    "campaign_id": "campaign_mismatch",
    "app_id": "app_mismatch",
    "user_id": "user_mismatch",
    "country": "country_mismatch",
    "platform": "platform_mismatch",
}

ERROR_TYPES = (
    "missing_tracking_id",
    "unknown_tracking_id",
    "duplicate_event_id",
    *MISMATCHES.values(),
)

CLEAN_COLUMNS = (
    "event_id",
    "tracking_id",
    "campaign_id",
    "app_id",
    "user_id",
    "event_type",
    "event_time",
    "revenue",
    "reward_cost",
    "country",
    "platform",
)


# Event ids are told apart by slot of their hash before they are compared.
SLOTS = 1 << 20


def _error(error_type: str, when: Column, *text: str | Column) -> Rule:
    record = F.struct(
        F.lit(error_type).alias("error_type"), message(*text).alias("error_message")
    )
    return Rule(error_type, when, record)


def _missing() -> Rule:
    return _error(
        "missing_tracking_id",
        F.col("tracking_id").isNull(),
        "Raw event ",
        F.col("event_id"),
        " has no tracking_id.",
    )


def _unknown(when: Column) -> Rule:
    return _error(
        "unknown_tracking_id",
        when,
        "Raw event ",
        F.col("event_id"),
        " references unknown tracking_id: ",
        F.col("tracking_id"),
    )


def _duplicate(when: Column) -> Rule:
    return _error(
        "duplicate_event_id",
        when,
        "Raw event_id ",
        F.col("event_id"),
        " appears multiple times in events_raw.",
    )


def _mismatch(column: str, when: Column | None = None) -> Rule:
    mine, theirs = F.col(column), F.col(f"request_{column}")
    differs = ~mine.eqNullSafe(theirs)
    return _error(
        MISMATCHES[column],
        differs if when is None else when & differs,
        "Raw event ",
        F.col("event_id"),
        f" {column} ",
        mine,
        f" does not match ad request {column} ",
        theirs,
        ".",
    )


def _request_side(requests: DataFrame, *columns: str) -> DataFrame:
    return requests.select(
        F.col("tracking_id").alias("request_tracking_id"),
        *[F.col(name).alias(f"request_{name}") for name in columns],
    )


def meet_requests(
    events: DataFrame, requests: DataFrame, how: str, *columns: str
) -> DataFrame:
    """Join events that may lack a tracking id to their ad request.

    NULL ids match nothing, yet an outer or anti join must keep their rows and
    would hash them all to one task.  They are spread by the unique
    ``raw_event_id`` instead; the second condition keeps a spread key from
    ever matching.  Hot non-NULL ids are left to the adaptive skew join, which
    may split the event side of all these join types.
    """
    spread = F.coalesce(
        F.col("tracking_id"), F.concat(F.lit("null-"), F.col("raw_event_id"))
    )
    keyed = events.withColumn("_join_id", spread)
    side = _request_side(requests, *columns)
    matches = (F.col("_join_id") == F.col("request_tracking_id")) & F.col(
        "tracking_id"
    ).isNotNull()
    return keyed.join(side, matches, how).drop("_join_id")


def _slot() -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(SLOTS)).alias("_slot")


def in_slots(events: DataFrame, slots: DataFrame, how: str) -> DataFrame:
    """The events whose id falls into a slot (``left_semi``) or into none (``left_anti``).

    There are no more than ``SLOTS`` of them, so they can always be broadcast, and
    events need not be shuffled to be told apart.
    """
    keyed = events.withColumn("_slot", _slot())
    return keyed.join(F.broadcast(slots), "_slot", how).drop("_slot")


def maybe_repeated(raw: DataFrame) -> DataFrame:
    """The events of which the id may repeat: all copies of repeated ids, and few others.

    Only a hash of the id is shuffled.
    """
    hashed = raw.groupBy(F.xxhash64("event_id").alias("_hash")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    slots = hashed.filter(F.col("copies") > 1).select(
        F.pmod("_hash", F.lit(SLOTS)).alias("_slot")
    )
    return in_slots(raw, slots.distinct(), "left_semi")


def duplicate_event_ids(raw: DataFrame) -> DataFrame:
    """Event ids that occur more than once.

    Only ``event_id`` is shuffled and repeats collapse before the shuffle.  Its
    measured size then lets adaptive execution broadcast a small set to the wide
    raw scan and sort-merge join a large one.
    """
    return (
        raw.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .select("event_id")
    )


def repeated_event_ids(raw: DataFrame) -> DataFrame:
    """The same ids, counted among the events of which the id may repeat.

    Reads the ids twice and shuffles hashes in their place.
    """
    return duplicate_event_ids(maybe_repeated(raw))


def _by_repeats(events: DataFrame, duplicates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events whose id is none of the duplicates, and those to be joined with them."""
    slots = duplicates.select(_slot()).distinct()
    return in_slots(events, slots, "left_anti"), in_slots(events, slots, "left_semi")


def checked_events(
    raw: DataFrame, requests: DataFrame, duplicates: DataFrame | None = None
) -> tuple[DataFrame, list[Rule]]:
    """Raw events next to their ad request, and the eight rules over that.

    An unknown tracking id has no request to differ from, so the five
    mismatch rules only apply where the request was found.  Given duplicates are joined
    in one scan; without them only events in the slots of repeated ids are shuffled by
    id, for more scans.
    """
    if duplicates is None:
        duplicates = repeated_event_ids(raw)
        single, others = _by_repeats(raw, duplicates)
        single = single.withColumn("_repeated", F.lit(None).cast("boolean"))
    else:
        single, others = None, raw
    flags = duplicates.select("event_id", F.lit(True).alias("_repeated"))
    flagged = others.join(flags, "event_id", "left")
    if single is not None:
        flagged = flagged.unionByName(single)
    met = meet_requests(flagged, requests, "left", *MISMATCHES)
    known = F.col("request_tracking_id").isNotNull()
    rules = [
        _missing(),
        _unknown(F.col("tracking_id").isNotNull() & ~known),
        _duplicate(F.col("_repeated")),
        *[_mismatch(column, known) for column in MISMATCHES],
    ]
    return met, rules


def classify_events(
    raw: DataFrame, requests: DataFrame, duplicates: DataFrame | None = None
) -> DataFrame:
    """Raw events plus ``errors``: (error_type, error_message) structs or NULL."""
    met, rules = checked_events(raw, requests, duplicates)
    return met.withColumn("errors", hits(rules)).select(*raw.columns, "errors")


def validation_errors(
    raw: DataFrame, requests: DataFrame, duplicates: DataFrame | None = None
) -> DataFrame:
    """Every broken rule of every event; an event may appear several times."""
    met, rules = checked_events(raw, requests, duplicates)
    return emit(met, rules, ERROR_KEYS)


def single_rule_errors(
    error_type: str,
    raw: DataFrame,
    requests: DataFrame,
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """One rule's errors, reading and shuffling only what that rule needs."""
    keys = raw.select(*ERROR_KEYS)
    if error_type == "missing_tracking_id":
        return emit(keys, [_missing()], ERROR_KEYS)
    if error_type == "unknown_tracking_id":
        known = requests.select("tracking_id")
        unknown = keys.filter(F.col("tracking_id").isNotNull()).join(
            known, "tracking_id", "left_anti"
        )
        return emit(unknown, [_unknown(F.lit(True))], ERROR_KEYS)
    if error_type == "duplicate_event_id":
        if duplicates is None:
            duplicates = duplicate_event_ids(raw)
        repeated = keys.join(duplicates, "event_id", "left_semi")
        return emit(repeated, [_duplicate(F.lit(True))], ERROR_KEYS)
    for column, name in MISMATCHES.items():
        if name == error_type:
            side = _request_side(requests, column)
            met = raw.select(*ERROR_KEYS, column).join(
                side, F.col("tracking_id") == F.col("request_tracking_id")
            )
            return emit(met, [_mismatch(column)], ERROR_KEYS)
    raise ValueError(f"unknown error type {error_type!r}")


def _as_clean(events: DataFrame) -> DataFrame:
    free = F.lit(0).cast("decimal(10,2)")
    return events.withColumns(
        {
            "revenue": F.coalesce("revenue", free),
            "reward_cost": F.coalesce("reward_cost", free),
        }
    ).select(*CLEAN_COLUMNS)


def events_clean(
    raw: DataFrame, requests: DataFrame, duplicates: DataFrame | None = None
) -> DataFrame:
    """Events without any error; missing money counts as 0.

    An event is clean when its id is unique and a request agrees with it on
    all six columns.  That is an anti join and a semi join: NULLs drop out of
    the equality by themselves and no request column is carried along.  Only events
    in the slots of repeated ids are shuffled by id.
    """
    if duplicates is None:
        duplicates = repeated_event_ids(raw)
    agreed = ["tracking_id", *MISMATCHES]
    single, others = _by_repeats(raw, duplicates)
    unique = single.unionByName(others.join(duplicates, "event_id", "left_anti"))
    return _as_clean(unique.join(requests.select(*agreed), agreed, "left_semi"))


def clean_of(classified: DataFrame) -> DataFrame:
    """The clean half of an already classified (stored) raw table."""
    return _as_clean(classified.filter(F.col("errors").isNull()))


def errors_of(classified: DataFrame) -> DataFrame:
    """The rejected half of an already classified (stored) raw table."""
    return (
        classified.filter(F.col("errors").isNotNull())
        .select(*ERROR_KEYS, F.explode("errors").alias("_error"))
        .select(*ERROR_KEYS, "_error.*")
    )


def pipeline_counts(
    raw: DataFrame, requests: DataFrame, duplicates: DataFrame | None = None
) -> DataFrame:
    """Raw, clean and rejected event counts in one row from one pass."""
    met, rules = checked_events(raw, requests, duplicates)
    return _outcome_counts(met.select((~any_hit(rules)).alias("is_clean")))


def stored_counts(validated: DataFrame) -> DataFrame:
    """The same row off a stored classified table, reading no column but the split."""
    return _outcome_counts(validated)


def _outcome_counts(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("raw_events"),
        F.count_if("is_clean").alias("clean_events"),
        F.count_if(~F.col("is_clean")).alias("rejected_raw_events"),
    )


def validation_error_summary(errors: DataFrame) -> DataFrame:
    return (
        errors.groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("error_count"))
        .orderBy(F.desc("error_count"), "error_type")
    )


def clean_event_distribution(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("clean_event_count"))
        .orderBy(F.desc("clean_event_count"), "event_type")
    )


def clean_duplicates(clean: DataFrame) -> DataFrame:
    """Invariant: clean event ids are unique, so this is empty."""
    return (
        clean.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def clean_orphans(clean: DataFrame, requests: DataFrame) -> DataFrame:
    """Invariant: every clean event has its ad request, so this is empty."""
    return clean.select("event_id", "tracking_id").join(
        requests.select("tracking_id"), "tracking_id", "left_anti"
    )


def rejected_events_view(errors: DataFrame) -> DataFrame:
    """Errors newest first; ids break ties so that sort ranges stay even."""
    newest = [F.desc("detected_at")] if "detected_at" in errors.columns else []
    return errors.orderBy(*newest, F.desc("raw_event_id"), "error_type")
