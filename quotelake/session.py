"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed join partitions and coalesces small ones;
#: everything else is left to the cluster's own configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where an aggregate on the join's key follows and needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> None:
    """Apply the adaptive-execution settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)


def build_session(
    app_name: str = "quotelake", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
