"""Which apps and users each active campaign could be delivered to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def eligible_inventory(
    campaigns: DataFrame, apps: DataFrame, users: DataFrame
) -> DataFrame:
    """Eligible app and user counts per active campaign, 0 where none fits.

    Apps fit by category and platform, users by country and platform.  Both
    are counted per trait pair first, so what joins is bounded by the number
    of pairs and neither apps nor users are paired with campaigns one by one.
    """
    fitting_apps = apps.groupBy(
        F.col("category").alias("target_category"),
        F.col("platform").alias("target_platform"),
    ).agg(F.count(F.lit(1)).alias("eligible_apps"))
    fitting_users = users.groupBy(
        F.col("country").alias("target_country"),
        F.col("platform").alias("target_platform"),
    ).agg(F.count(F.lit(1)).alias("eligible_users"))
    return (
        campaigns.filter(F.col("status") == "active")
        .join(fitting_apps, ["target_category", "target_platform"], "left")
        .join(fitting_users, ["target_country", "target_platform"], "left")
        .select(
            "campaign_id",
            "target_country",
            "target_platform",
            "target_category",
            "bid_cpi",
            F.coalesce("eligible_apps", F.lit(0)).alias("eligible_apps"),
            F.coalesce("eligible_users", F.lit(0)).alias("eligible_users"),
        )
        .orderBy("campaign_id")
    )
