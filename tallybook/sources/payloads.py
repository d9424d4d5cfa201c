"""Blobs on disk, reduced to what verification needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.sources.pointers import relative_path


def scan_payloads(spark: SparkSession, root: str) -> DataFrame:
    """path, actual_oid, actual_size for each file below ``root``.

    Hashing happens where the file is read; only 64 digits and a length travel.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root.rstrip("/"))
    return files.select(
        relative_path(F.col("path"), root).alias("path"),
        F.sha2("content", 256).alias("actual_oid"),
        F.col("length").alias("actual_size"),
    )
