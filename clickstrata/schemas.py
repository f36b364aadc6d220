"""Declared tables: column types plus the constraints the audit job checks.

Spark does not enforce keys, domains or lengths on write, so they are kept
here as data and turned into one report by ``operators.audit``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Money per row is DECIMAL(10,2).  Aggregates are wider than a single-node
# store would need: 10**12 events overflow DECIMAL(12,2), and ANSI mode would
# fail the job instead of storing a wrong total.
PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(20, 2)
RATE = T.DecimalType(18, 4)
PERCENT = T.DecimalType(18, 2)

# The domains of the enumerated columns.
PLATFORMS = ("android", "ios")
CAMPAIGN_STATUSES = ("active", "paused")
VARIANTS = ("A", "B")
NOW = "now"
EVENT_TYPES = ("impression", "click", "install", "conversion", "reward")
ALERT_TYPES = ("data_quality", "performance", "experiment")
SEVERITIES = ("low", "medium", "high")
ENTITY_TYPES = ("campaign", "app", "tracking_id", "experiment", "system")


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = True
    max_length: int | None = None
    domain: tuple[str, ...] | None = None
    # What an insert that leaves the column out stores: text Spark casts to
    # the column's type, or NOW; None stores NULL.
    default: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.type, not c.required) for c in self.columns]
        )


def _long(name: str, required: bool = True) -> Column:
    return Column(name, T.LongType(), required)


def _text(name: str, size: int | None = None, required: bool = True) -> Column:
    return Column(name, T.StringType(), required, max_length=size)


def _enum(
    name: str,
    domain: tuple[str, ...],
    required: bool = True,
    default: str | None = None,
) -> Column:
    return Column(name, T.StringType(), required, domain=domain, default=default)


def _decimal(
    name: str,
    kind: T.DecimalType,
    required: bool = True,
    default: str | None = None,
) -> Column:
    return Column(name, kind, required, default=default)


def _time(name: str, required: bool = True, default: str | None = None) -> Column:
    return Column(name, T.TimestampNTZType(), required, default=default)


def _date(name: str, required: bool = True) -> Column:
    return Column(name, T.DateType(), required)


_CREATED = _time("created_at", required=False, default=NOW)
_TO_CAMPAIGN = ForeignKey("campaign_id", "campaigns", "campaign_id")
_TO_APP = ForeignKey("app_id", "apps", "app_id")
_TO_USER = ForeignKey("user_id", "users", "user_id")

_DECLARED = (
    Table(
        "publishers",
        (
            _long("publisher_id"),
            _text("publisher_name", 100),
            _text("country", 2),
            _CREATED,
        ),
        primary_key=("publisher_id",),
    ),
    Table(
        "apps",
        (
            _long("app_id"),
            _long("publisher_id"),
            _text("app_name", 100),
            _text("category", 50),
            _enum("platform", PLATFORMS),
            _text("country", 2),
            _CREATED,
        ),
        primary_key=("app_id",),
        foreign_keys=(ForeignKey("publisher_id", "publishers", "publisher_id"),),
    ),
    Table(
        "advertisers",
        (
            _long("advertiser_id"),
            _text("advertiser_name", 100),
            _text("industry", 50, required=False),
            _CREATED,
        ),
        primary_key=("advertiser_id",),
    ),
    Table(
        "campaigns",
        (
            _long("campaign_id"),
            _long("advertiser_id"),
            _text("campaign_name", 100),
            _text("target_country", 2),
            _enum("target_platform", PLATFORMS),
            _text("target_category", 50),
            _decimal("bid_cpi", PRICE),
            _decimal("daily_budget", T.DecimalType(12, 2)),
            _enum("status", CAMPAIGN_STATUSES, required=False, default="active"),
            _CREATED,
        ),
        primary_key=("campaign_id",),
        foreign_keys=(ForeignKey("advertiser_id", "advertisers", "advertiser_id"),),
    ),
    Table(
        "users",
        (
            _long("user_id"),
            _text("country", 2),
            _enum("platform", PLATFORMS),
            _text("device_type", 50, required=False),
            _CREATED,
        ),
        primary_key=("user_id",),
    ),
    Table(
        "experiments",
        (
            _long("experiment_id"),
            _text("experiment_name", 100),
            _enum("variant", VARIANTS),
            _text("algorithm_name", 100),
            _date("start_date"),
            _date("end_date", required=False),
            _CREATED,
        ),
        primary_key=("experiment_id",),
    ),
    Table(
        "ad_requests",
        (
            _long("ad_request_id"),
            _text("tracking_id", 100),
            _long("user_id"),
            _long("app_id"),
            _long("campaign_id"),
            _long("experiment_id", required=False),
            _time("request_time"),
            _text("country", 2),
            _enum("platform", PLATFORMS),
        ),
        primary_key=("ad_request_id",),
        unique=(("tracking_id",),),
        foreign_keys=(
            _TO_USER,
            _TO_APP,
            _TO_CAMPAIGN,
            ForeignKey("experiment_id", "experiments", "experiment_id"),
        ),
    ),
    # The landing table is loose on purpose: bad rows must be able to arrive.
    Table(
        "events_raw",
        (
            _long("raw_event_id"),
            _text("event_id", 100),
            _text("tracking_id", 100, required=False),
            _long("campaign_id", required=False),
            _long("app_id", required=False),
            _long("user_id", required=False),
            _enum("event_type", EVENT_TYPES),
            _time("event_time"),
            _decimal("revenue", PRICE, required=False, default="0.00"),
            _decimal("reward_cost", PRICE, required=False, default="0.00"),
            _text("country", 2, required=False),
            _enum("platform", PLATFORMS, required=False),
            _CREATED,
        ),
        primary_key=("raw_event_id",),
    ),
    # Keyed by event_id: a surrogate sequence has no use in a distributed write.
    Table(
        "events_clean",
        (
            _text("event_id", 100),
            _text("tracking_id", 100),
            _long("campaign_id"),
            _long("app_id"),
            _long("user_id"),
            _enum("event_type", EVENT_TYPES),
            _time("event_time"),
            _decimal("revenue", PRICE, default="0.00"),
            _decimal("reward_cost", PRICE, default="0.00"),
            _text("country", 2),
            _enum("platform", PLATFORMS),
            _CREATED,
        ),
        primary_key=("event_id",),
        foreign_keys=(
            ForeignKey("tracking_id", "ad_requests", "tracking_id"),
            _TO_CAMPAIGN,
            _TO_APP,
            _TO_USER,
        ),
    ),
    Table(
        "daily_campaign_metrics",
        (
            _date("metric_date"),
            _long("campaign_id"),
            _long("impressions"),
            _long("clicks"),
            _long("installs"),
            _long("conversions"),
            _long("rewards"),
            _decimal("ctr", RATE),
            _decimal("install_rate", RATE),
            _decimal("conversion_rate", RATE),
            _decimal("spend", MONEY),
            _decimal("revenue", MONEY),
            _decimal("profit", MONEY),
            _decimal("ecpm", MONEY),
        ),
        primary_key=("metric_date", "campaign_id"),
        foreign_keys=(_TO_CAMPAIGN,),
    ),
    Table(
        "daily_app_metrics",
        (
            _date("metric_date"),
            _long("app_id"),
            _long("impressions"),
            _long("clicks"),
            _long("installs"),
            _long("conversions"),
            _decimal("revenue", MONEY),
            _decimal("reward_cost", MONEY),
        ),
        primary_key=("metric_date", "app_id"),
        foreign_keys=(_TO_APP,),
    ),
    Table(
        "alerts",
        (
            _text("rule_id"),
            _text("rule_group"),
            _enum("alert_type", ALERT_TYPES),
            _enum("severity", SEVERITIES),
            _enum("entity_type", ENTITY_TYPES),
            _text("entity_id", 100, required=False),
            _text("alert_message"),
            _time("detected_at", default=NOW),
            Column("is_resolved", T.BooleanType(), default="false"),
        ),
        # A bag: the same finding may be logged once per offending event.
        primary_key=(),
    ),
    Table(
        "experiment_results",
        (
            _text("experiment_name", 100),
            _enum("variant", VARIANTS),
            _text("algorithm_name", 100),
            _long("ad_requests"),
            _long("impressions"),
            _long("clicks"),
            _long("installs"),
            _long("conversions"),
            _long("rewards"),
            _decimal("impression_rate", RATE),
            _decimal("ctr", RATE),
            _decimal("install_rate", RATE),
            _decimal("conversion_rate", RATE),
            _decimal("spend", MONEY),
            _decimal("revenue", MONEY),
            _decimal("reward_cost", MONEY),
            _decimal("profit", MONEY),
            _decimal("ecpm", MONEY),
            _time("calculated_at", default=NOW),
        ),
        primary_key=("experiment_name", "variant", "algorithm_name"),
    ),
    Table(
        "event_validation_errors",
        (
            _long("raw_event_id"),
            _text("event_id", 100, required=False),
            _text("tracking_id", 100, required=False),
            _text("error_type", 100),
            _text("error_message"),
            _time("detected_at", default=NOW),
        ),
        primary_key=("raw_event_id", "error_type"),
        foreign_keys=(ForeignKey("raw_event_id", "events_raw", "raw_event_id"),),
    ),
)

TABLES: dict[str, Table] = {table.name: table for table in _DECLARED}
