"""Intermediate tables, kept in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tallybook-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table, below a folder of this application."""
    return f"{shared_dir(spark)}/tallybook-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes the rows as a table and reads them back.

    Rows are fixed from here on and the lineage ends: a lost executor costs a
    read and not a second, perhaps different, computation. Unlike a checkpoint,
    a table can be read by column, and it carries over no partitioning.
    """
    where = scratch_path(df.sparkSession, name)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the intermediate tables of this application; results that read them must be done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/tallybook-{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
