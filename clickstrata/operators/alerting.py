"""What all alert rules share: the alert record, refresh and listings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.rules import Rule
from clickstrata.functions.text import message

ALERT_COLUMNS = (
    "rule_id",
    "rule_group",
    "alert_type",
    "severity",
    "entity_type",
    "entity_id",
    "alert_message",
)

# Groups are what a refresh replaces; the message text stays presentation.
DATA_QUALITY = "data_quality"
GENERATED_MONITORING = "generated_monitoring"
EXPERIMENT_MONITORING = "experiment_monitoring"
MONITORING_GROUPS = (GENERATED_MONITORING, EXPERIMENT_MONITORING)

# The order severities are listed in.
SEVERITY_ORDER = {"high": 1, "medium": 2, "low": 3}


@dataclass(frozen=True)
class AlertKind:
    """The constant part of a rule's alerts."""

    rule_id: str
    rule_group: str
    alert_type: str
    severity: str
    entity_type: str

    def rule(self, when: Column, entity: Column, *text: str | Column) -> Rule:
        record = F.struct(
            F.lit(self.rule_id).alias("rule_id"),
            F.lit(self.rule_group).alias("rule_group"),
            F.lit(self.alert_type).alias("alert_type"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.entity_type).alias("entity_type"),
            entity.cast("string").alias("entity_id"),
            message(*text).alias("alert_message"),
        )
        return Rule(self.rule_id, when, record)


def union_alerts(*parts: DataFrame) -> DataFrame:
    """Rule outputs as one bag."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def open_alerts(alerts: DataFrame) -> DataFrame:
    """Fresh alerts with the log's default state."""
    return alerts.withColumn("is_resolved", F.lit(False))


def refresh_alerts(
    stored: DataFrame, fresh: DataFrame, groups: tuple[str, ...]
) -> DataFrame:
    """Drop the named groups from the stored alerts and put the fresh ones in."""
    return stored.filter(~F.col("rule_group").isin(*groups)).unionByName(fresh)


def severity_rank() -> Column:
    rank = F.lit(None).cast("int")
    for severity, place in SEVERITY_ORDER.items():
        rank = F.when(F.col("severity") == severity, place).otherwise(rank)
    return rank


def alerts_listing(alerts: DataFrame) -> DataFrame:
    """High before medium before low, newest first inside a severity.

    The trailing keys make the order total, which also lets the range sort cut
    a severity holding most alerts into many even ranges.
    """
    newest = [F.desc("detected_at")] if "detected_at" in alerts.columns else []
    return alerts.orderBy(
        severity_rank(), *newest, "alert_type", "entity_type", "entity_id", "alert_message"
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("alert_type", "severity")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy("alert_type", "severity")
    )
