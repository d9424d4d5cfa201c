"""Session settings the jobs are tuned for. Any Spark session works; these help."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins on hot keys and tiny post-shuffle partitions are left to AQE.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Pointer files are ~130 bytes each. The default cost of opening a file (4 MiB)
# would give every 30 files a task of their own.
POINTER_SCAN_SETTINGS = {"spark.sql.files.openCostInBytes": "4096"}


def build_session(app_name: str = "tallybook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS applied; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
