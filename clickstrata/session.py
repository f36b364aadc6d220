"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a cluster alike.  Partition counts are
# only a starting point: adaptive execution coalesces or splits them by size.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile methods above 8,000 bytes, so a stage fused into
    # a longer one runs interpreted.  Below this limit Spark falls back to
    # per-expression code, which is several times faster for such stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def shuffle_partitions_for(
    shuffled_bytes: int, cores: int, target_bytes: int = 256 * 1024**2
) -> int:
    """Initial shuffle partitions for a run of known size.

    Adaptive execution merges partitions that turn out small but never adds
    any, so a large run has to start with enough of them: each about
    ``target_bytes``, which a task sorts in memory, and at least one per core.
    """
    return max(cores, -(-shuffled_bytes // target_bytes))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings that a session made elsewhere leaves open."""
    chosen = spark._jsparkSession.sessionState().conf()
    for key, value in RECOMMENDED.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "clickstrata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create (or get) a session carrying the recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
