"""Session defaults for the jobs in this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs rely on at scale. They are defaults: whatever the cluster already sets wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str = "medloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
