"""The pointer scan in steps: each run picks up files not seen before.

This is the batch scan on a streaming source. The source still lists the whole tree
on the driver and keeps the names it has seen: it saves reading, not listing.
Pointers carry no time, so there is no watermark and no other state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.validation import quarantine
from tallybook.plans.ingest import checked_pointers
from tallybook.sources.manifests import MANIFEST_SCHEMA, write_manifest
from tallybook.sources.pointers import POINTER_MAX_BYTES, pointer_files, read_pointer, relative_path

# Fixed value: columns of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _files(spark: SparkSession, root: str, max_files_per_trigger: int) -> DataFrame:
    source = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    return source.option("maxFilesPerTrigger", max_files_per_trigger).load(root.rstrip("/"))


def stream_pointers(spark: SparkSession, root: str, max_files_per_trigger: int = 100_000) -> DataFrame:
    """Streaming form of ``scan_pointers``."""
    return read_pointer(pointer_files(_files(spark, root, max_files_per_trigger), root))


def ingest_new_pointers(
    spark: SparkSession, root: str, out: str, checkpoint_location: str, max_files_per_trigger: int = 100_000
) -> StreamingQuery:
    """Adds new pointers to ``out``/manifest, new faulty or too large files to ``out``/quarantine, and stops when all are read.

    A batch writes folders of its own number, and writes them anew if it is run again, so a run cut
    short and started again neither loses nor repeats a file. Empty files give no row in a stream.
    """
    large = _files(spark, root, max_files_per_trigger).filter(F.col("_metadata.file_size") > POINTER_MAX_BYTES)
    large = large.select(relative_path(F.col("path"), root).alias("path"), F.lit(None).cast("string").alias("value"), F.lit(True).alias("large"))
    small = pointer_files(_files(spark, root, max_files_per_trigger), root).withColumn("large", F.lit(False))
    where = out.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        at = f"{where}/checked/batch={number}"
        checked = checked_pointers(read_pointer(batch))
        checked = checked.withColumn("reason", F.when(F.col("large"), "not a pointer").otherwise(F.col("reason")))
        checked.drop("large").write.mode("overwrite").parquet(at)
        valid, faulty = quarantine(batch.sparkSession.read.parquet(at))
        write_manifest(valid.select(*MANIFEST_SCHEMA.fieldNames()), f"{where}/manifest/batch={number}", mode="overwrite")
        faulty.select("path", "reason").write.mode("overwrite").parquet(f"{where}/quarantine/batch={number}")

    return (
        small.union(large)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
