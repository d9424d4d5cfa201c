"""Pointer files to a manifest table and a quarantine table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.paths import parse_path
from tallybook.operators.validation import quarantine, validate_manifest
from tallybook.sources.manifests import MANIFEST_SCHEMA, write_manifest
from tallybook.sources.pointers import POINTER_MAX_BYTES, binary_files, listed_files, misfit_files, scan_pointers
from tallybook.sources.tree import scan_tree


def checked_pointers(scanned: DataFrame) -> DataFrame:
    """Scanned pointers with path attributes and ``reason``, batch or stream."""
    return validate_manifest(parse_path(scanned))


def build_manifest(
    spark: SparkSession, root: str, out: str, subdirs: Sequence[str] = (), inventory: DataFrame | None = None, depth: int | None = None
) -> None:
    """Reads pointers below ``root`` once, writes ``out``/checked, ``out``/manifest and ``out``/quarantine.

    Every file found is in the manifest or the quarantine. The scan is the dear
    part (one open per file). Its result is written before it is divided, so the files
    are not opened a second time for the quarantine. Files too large for a pointer go
    to the quarantine unread, and so do files that gave no row, which are the empty ones.
    ``inventory`` (path below the root) is what there should be; without it, what was
    listed. ``subdirs`` takes a large tree by folders, each to an ``out`` of its own. ``depth`` has the tree
    listed by tasks, one for each folder so far down, and not by the driver.
    """
    where = out.rstrip("/")
    if depth is not None:
        if subdirs:
            raise ValueError("depth lists the whole tree; give no subdirs")
        _scan_by_tasks(spark, root, where, inventory, depth)
        return
    files = binary_files(spark, root, subdirs)
    checked_pointers(scan_pointers(spark, root, subdirs)).write.parquet(f"{where}/checked")
    checked = _divided(spark, where)
    misfits = misfit_files(spark, root, subdirs).select("path", F.lit("not a pointer").alias("reason"))
    expected = (listed_files(files, root) if inventory is None else inventory.select("path")).distinct()
    unread = expected.join(checked.select("path").unionByName(misfits.select("path")), "path", "left_anti")
    unread = unread.withColumn("reason", F.lit("empty or missing"))
    faulty = quarantine(checked)[1]
    faulty.select("path", "reason").unionByName(misfits).unionByName(unread).write.parquet(f"{where}/quarantine")


def _divided(spark: SparkSession, where: str) -> DataFrame:
    """Writes the valid rows of ``where``/checked to ``where``/manifest; gives all checked rows."""
    checked = spark.read.parquet(f"{where}/checked")
    write_manifest(quarantine(checked)[0].select(*MANIFEST_SCHEMA.fieldNames()), f"{where}/manifest")
    return checked


def _scan_by_tasks(spark: SparkSession, root: str, where: str, inventory: DataFrame | None, depth: int) -> None:
    size = F.col("file_size")
    reason = F.when(size == 0, "empty or missing").when(size > POINTER_MAX_BYTES, "not a pointer").otherwise(F.col("reason"))
    checked_pointers(scan_tree(spark, root, depth)).withColumn("reason", reason).write.parquet(f"{where}/checked")
    checked = _divided(spark, where)
    faulty = quarantine(checked)[1].select("path", "reason")
    if inventory is not None:
        missing = inventory.select("path").distinct().join(checked.select("path"), "path", "left_anti")
        faulty = faulty.unionByName(missing.withColumn("reason", F.lit("empty or missing")))
    faulty.write.parquet(f"{where}/quarantine")
