"""Equal content under several paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe, join_summary
from tallybook.functions.ordering import first_n, with_runs
from tallybook.functions.storage import store


def duplicate_groups(df: DataFrame, oid: str = "oid", path: str = "path") -> DataFrame:
    """Oid, n, first_path for each oid that occurs more than once."""
    return (
        df.groupBy(oid).agg(F.count(F.lit(1)).alias("n"), F.min(path).alias("first_path")).filter(F.col("n") > 1)
    )


def exact_dedup(df: DataFrame, order: Sequence[str], oid: str = "oid") -> DataFrame:
    """The first row of each oid by ``order``, which must break all ties.

    Each map task ships one row per oid at most, so an oid with a third of all
    rows costs no more than any other.
    """
    return first_n(df, [oid], [F.col(c) for c in order], 1).select(*[F.col(f"`{c}`") for c in df.columns])


def dedup_savings(df: DataFrame, group: str, oid: str = "oid", size: str = "size") -> DataFrame:
    """D3: per group, bytes as listed, bytes with one copy of each oid, and the difference."""
    per_oid = df.groupBy(group, oid).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_logical"), F.max(size).alias("_physical")
    )
    return (
        per_oid.groupBy(group)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_oids"),
            F.sum("_logical").alias("logical_bytes"),
            F.sum("_physical").alias("physical_bytes"),
        )
        .withColumn("saved_bytes", F.col("logical_bytes") - F.col("physical_bytes"))
    )


def cross_partition_duplicates(df: DataFrame, partition: str, oid: str = "oid") -> DataFrame:
    """Oid, partition and n_partitions, a row for each partition of an oid that is in several.

    Null is no partition; a null oid is an oid like others. Copies inside one partition collapse before any shuffle
    by oid, and nothing is listed in one row: an oid in every partition is as many rows.
    """
    held = df.filter(F.col(partition).isNotNull()).select(oid, partition).distinct()
    # After the distinct an oid has a row for each partition at most, whatever the number of its copies.
    n_partitions = F.count(F.lit(1)).over(Window.partitionBy(oid))
    return held.withColumn("n_partitions", n_partitions).filter(F.col("n_partitions") > 1)


def identity_conflicts(df: DataFrame, attribute: str, oid: str = "oid") -> DataFrame:
    """Oid, n_values for each oid that comes with several values of ``attribute``.

    Null counts as no value. The (oid, value) pairs are made distinct first, so
    copies of one oid are spread over tasks and collapse there.
    """
    return (
        df.filter(F.col(attribute).isNotNull())
        .select(oid, attribute)
        .distinct()
        .groupBy(oid)
        .agg(F.count(F.lit(1)).alias("n_values"))
        .filter(F.col("n_values") > 1)
    )


def duplicate_runs(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str = "oid", min_length: int = 1
) -> DataFrame:
    """Runs of equal ``value`` in order, of ``min_length`` rows or more."""
    return with_runs(df, group, order, value).filter(F.col("length") >= min_length)


def origin_overlap(df: DataFrame, group: str, oid: str = "oid") -> DataFrame:
    """group_a, group_b, n_shared for each two groups that share oids; null is no group.

    Oids found in the same groups are counted together: two hashes added up over an oid's groups stand for
    the combination. Only one oid of each combination is then paired with itself on its
    groups. Nothing is listed in one row, and no row of the table is ever paired.
    """
    held = df.filter(F.col(group).isNotNull()).select(F.col(oid).alias("oid"), F.col(group).alias("g")).distinct()
    marks = [F.sum(F.xxhash64(F.lit(seed), "g").cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
    found = held.groupBy("oid").agg(F.count(F.lit(1)).alias("n"), *marks).filter("n > 1")
    shown = found.groupBy("n", "h1", "h2").agg(F.min("oid").alias("oid"), F.count(F.lit(1)).alias("n_oids"))
    rows = store(join_summary(held, shown.select("oid", "n_oids"), ["oid"]), "combinations")
    other = rows.select("oid", F.col("g").alias("group_b"))
    pairs = join_null_safe(rows.withColumnRenamed("g", "group_a"), other, ["oid"]).filter("group_a < group_b")
    return pairs.groupBy("group_a", "group_b").agg(F.sum("n_oids").alias("n_shared"))
