"""Times the headline jobs and one full pipeline run; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
import uuid

from clickstrata.plans.catalog import registered
from clickstrata.plans.jobs import Jobs
from clickstrata.plans.pipeline import Inputs, Pipeline
from clickstrata.session import build_session
from clickstrata.sources.tables import Warehouse

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "campaign_kpi",
    "funnel_by_tracking",
    "daily_campaign_metrics_raw",
    "daily_app_metrics_raw",
    "validation_errors",
    "events_clean",
    "pipeline_counts",
    "daily_campaign_metrics",
    "daily_app_metrics",
    "campaigns_best",
    "apps_by_revenue",
    "publisher_performance",
    "country_platform_performance",
    "category_performance",
    "experiment_results",
    "experiment_uplift",
    "experiment_daily_trend",
    "dq_missing_or_unknown_tracking",
    "dq_targeting_mismatch",
    "dq_alerts_all",
    "mon_daily_ctr_drop",
    "monitoring_alerts",
    "alerts_view",
    "overview_totals",
    "constraint_audit",
    "scoped_purge",
    "eligible_inventory",
)


def main() -> None:
    spark = build_session(
        "clickstrata-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = registered()
    # One untimed run starts the executor threads and the Parquet reader.
    jobs["volume_events"](spark, FOLDER).collect()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The noop sink computes every row and column without moving them.
        jobs[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)

    tables = Jobs(spark, FOLDER)
    inputs = Inputs(
        tables.events_raw, tables.ad_requests, tables.campaigns, tables.experiments
    )
    root = spark.conf.get("spark.sql.warehouse.dir")
    warehouse = Warehouse(spark, f"{root}/bench-{uuid.uuid4().hex}")
    start = time.perf_counter()
    Pipeline(warehouse, inputs, tables.scope).run()
    timings["full_pipeline_refresh"] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(FOLDER)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
