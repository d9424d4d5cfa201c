"""M4: manifests as Parquet tables partitioned by origin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.paths import ATTRIBUTES

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("oid", T.StringType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("origin", T.StringType(), True),
        *[T.StructField(name, kind, True) for name, kind in ATTRIBUTES.items()],
    ]
)


def write_manifest(
    df: DataFrame,
    out: str,
    partition: str = "origin",
    order: Sequence[str] = ("ordinal", "path"),
    mode: str = "errorifexists",
) -> None:
    """Writes one folder per ``partition`` value, rows in ``order``.

    Rows are spread by ranges of (partition, order): an origin with most of the
    rows is cut over many tasks and files, a small one gets one file, and each
    file covers a narrow range of ``order``, which lets readers skip files.
    """
    keys = [partition, *order]
    (
        df.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .write.mode(mode)
        .partitionBy(partition)
        .parquet(out)
    )


def read_manifest(spark: SparkSession, where: str, schema: T.StructType = MANIFEST_SCHEMA) -> DataFrame:
    """A written manifest; a filter on the partition column prunes folders."""
    return spark.read.schema(schema).parquet(where).select(*schema.fieldNames())


def write_bucketed(df: DataFrame, table: str, where: str, buckets: int, by: Sequence[str] = ("oid",)) -> DataFrame:
    """Writes ``df`` as the catalog table ``table`` at ``where``, bucketed and sorted by ``by``, and returns it.

    Grouping, deduplication and joins by ``by`` (of tables with as many buckets) need no shuffle any more: rows are dealt once, when
    written. One task writes each bucket, so choose as many as shuffle partitions; a bucket holds all rows of a hot key.
    """
    keys = [F.col(k) for k in by]
    df.repartition(buckets, *keys).write.bucketBy(buckets, *by).sortBy(*by).option("path", where).saveAsTable(table)
    return df.sparkSession.table(table)
