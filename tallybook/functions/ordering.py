"""Ordered work inside groups that may be too large for one task.

A plain window needs every row of a group in one task. These helpers first cut
the rows into ranges of the full (group, order) key, so that a group holding a
third of the table becomes many ranges, do the ordered work inside each range,
and then reconcile the ranges through a summary of a few rows per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe
from tallybook.functions.names import free_names
from tallybook.functions.storage import store

GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def _keep(df: DataFrame, group: Sequence[str], extra: Sequence[str]) -> None:
    missing = [c for c in [*group, *extra] if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in a column ``rank`` (``rank_`` if there is a rank already, and so on).

    Up to the optimizer's group-limit threshold every map task ships at most
    ``n`` rows of a group, whatever the size of the group. Beyond it the rank is
    taken range by range, which needs no such limit.
    """
    _keep(df, group, [])
    rank, whole = free_names(df.columns, rank, "group_total")
    threshold = int(df.sparkSession.conf.get(GROUP_LIMIT_SETTING, "1000"))
    if n <= threshold:
        numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    else:
        numbered = running_total(df, group, order, total=rank, whole=whole).drop(whole)
        numbered = numbered.withColumn(rank, F.col(rank).cast("int"))
    return numbered.filter(F.col(rank) <= n)


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    weight: str | None = None,
    total: str = "running_total",
    whole: str = "group_total",
) -> DataFrame:
    """Exact running sum of ``weight`` (or row number) in each group as ``total``, and the group's sum as ``whole``.

    ``order`` must be unique within a group. Rows go to ranges of (group, order);
    the table they are written to pins which row is in which range, since the
    ranges come from a sample and both the summary and the rows must see the same ones.
    """
    _keep(df, group, [weight] if weight else [])
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    in_range, start, part = free_names([*df.columns, total, whole], "_range", "_start", "_amount")
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order)
    ranged = store(ranged.withColumn(in_range, F.spark_partition_id()))

    per_range = ranged.groupBy(*group, in_range).agg(F.sum(amount).alias(part))
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy(in_range).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        *group,
        in_range,
        F.coalesce(F.sum(part).over(earlier), F.lit(0)).alias(start),
        F.sum(part).over(of_group).alias(whole),
    )
    inside = (
        Window.partitionBy(*group, in_range).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        join_null_safe(ranged, starts, [*group, in_range])
        .withColumn(total, F.col(start) + F.sum(amount).over(inside))
        .drop(in_range, start)
    )


def with_runs(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Maximal runs of equal ``value`` along ``order`` in each group.

    Returns group, value, ``first_<c>`` and ``last_<c>`` for each order column,
    and ``length``. ``order`` must be unique within a group.

    One linear plan: pieces of runs are found inside each range, and only the
    first and last piece of a range can go on in another one. Those, at most two
    for each range, meet in one window per group; all other pieces stay with
    their range (``_meet``).
    """
    _keep(df, group, [*order, value])
    # Plain names of its own for all columns, so none of the table's can be in the way.
    keys, places = [f"g{i}" for i in range(len(group))], [f"o{i}" for i in range(len(order))]
    named = [F.col(c).alias(n) for c, n in zip([*group, *order, value], [*keys, *places, "v"])]
    ranged = (
        df.select(*named)
        .repartitionByRange(*[F.col(c) for c in [*keys, *places]])
        .withColumn("_range", F.spark_partition_id())
    )
    in_range = Window.partitionBy(*keys, "_range")
    along = in_range.orderBy(*places)
    is_first = F.row_number().over(along) == 1
    same = F.col("v").eqNullSafe(F.lag("v").over(along))
    pieces = (
        ranged.withColumn("_new", F.when(is_first | ~same, 1).otherwise(0))
        .withColumn("_piece", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*keys, "_range", "_piece")
        .agg(
            F.min(F.struct(*places)).alias("_first"),
            F.max(F.struct(*places)).alias("_last"),
            F.max("v").alias("v"),
            F.count(F.lit(1)).alias("_length"),
        )
        .withColumn("_pieces", F.max("_piece").over(in_range))
    )
    at_edge = (F.col("_piece") == 1) | (F.col("_piece") == F.col("_pieces"))
    pieces = pieces.withColumn("_meet", F.when(at_edge, -1).otherwise(F.col("_range")))

    meeting = Window.partitionBy(*keys, "_meet").orderBy("_range", "_piece")
    goes_on = (F.lag("_range").over(meeting) != F.col("_range")) & F.lag("v").over(meeting).eqNullSafe(F.col("v"))
    runs = (
        pieces.withColumn("_goes_on", F.coalesce(goes_on, F.lit(False)))
        .withColumn(
            "_run",
            F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(
                meeting.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .groupBy(*keys, "_meet", "_run")
        .agg(
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.max("v").alias("v"),
            F.sum("_length").alias("length"),
        )
    )
    return runs.select(
        *[F.col(n).alias(c) for c, n in zip(group, keys)],
        F.col("v").alias(value),
        *[F.col("_first")[n].alias(f"first_{c}") for c, n in zip(order, places)],
        *[F.col("_last")[n].alias(f"last_{c}") for c, n in zip(order, places)],
        "length",
    )
