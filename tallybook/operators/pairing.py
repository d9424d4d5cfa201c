"""Records that belong together under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_summary


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    fields = list(dict.fromkeys([*order, *keep]))
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*fields)).alias("_first"), F.count(F.lit(1)).alias("n_right"))
        .select(*keys, *[F.col(f"_first.{c}").alias(f"right_{c}") for c in keep], "n_right")
    )


def matched_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Each left row that has a partner, once, next to it.

    Columns ``keep`` come as ``left_*`` and ``right_*``. Keys are unique on each
    side of a sound manifest. Should the right side repeat a key, its first row
    by ``order`` is the partner and ``n_right`` tells how many there were: the
    output never grows beyond the left side, whatever key is repeated.
    ``repeated_partners`` lists all right rows of such keys.
    """
    partners = _first_per_key(right, keys, order, keep)
    named = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in keep])
    return join_summary(named.dropna(subset=list(keys)), partners, keys)


def repeated_partners(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P1, report: all rows whose full key comes several times, with ``n_right``, how often."""
    full = df.dropna(subset=list(keys))
    repeated = full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right")).filter(F.col("n_right") > 1)
    return join_summary(full, repeated, keys)


def pair_coverage(df: DataFrame, keys: Sequence[str], side: Column, within: Sequence[str] = ()) -> DataFrame:
    """Number of keys found on both sides, on the left only and on the right only.

    ``side`` is 'left', 'right' or null (row takes no part). Both sides are read
    in one pass and meet in one aggregation, so no join is needed. ``within``
    must be part of the keys; rows without a full key are left out.
    """
    per_key = (
        df.withColumn("_side", side)
        .filter(F.col("_side").isin("left", "right"))
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            F.max((F.col("_side") == "left").cast("int")).alias("_left"),
            F.max((F.col("_side") == "right").cast("int")).alias("_right"),
        )
    )
    status = F.when((F.col("_left") == 1) & (F.col("_right") == 1), "both").when(
        F.col("_left") == 1, "left only"
    ).otherwise("right only")
    return per_key.groupBy(*within, status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def unpaired(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of either side with no partner, marked by ``side``.

    The other side of each anti-join holds every key once, so a key with many
    rows is repeated on one side at most. Rows without a full key have
    no partner.
    """
    left_only = join_summary(left, right.select(*keys).dropna().distinct(), keys, "left_anti")
    right_only = join_summary(right, left.select(*keys).dropna().distinct(), keys, "left_anti")
    return left_only.withColumn("side", F.lit("left")).unionByName(right_only.withColumn("side", F.lit("right")))


def pair_size_ratio(pairs: DataFrame, within: Sequence[str], size: str = "size") -> DataFrame:
    """Per group of pairs, mean of right size over left size and how often right is smaller."""
    left, right = F.col(f"left_{size}"), F.col(f"right_{size}")
    return pairs.groupBy(*within).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg(F.when(left != 0, right / left)).alias("mean_ratio"),
        F.count_if(right < left).alias("n_right_smaller"),
    )
