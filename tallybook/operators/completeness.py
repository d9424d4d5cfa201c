"""What is absent, misplaced or cut off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.joins import join_summary
from tallybook.functions.names import free_names
from tallybook.functions.storage import store

# Ordinals are worked on in blocks of this many neighbours: a task holds one
# block, and a group of 10^12 ordinals has a million blocks.
BLOCK = 1 << 20


def _block(ordinal: str, block: int) -> Column:
    """Lowest ordinal of the block, right for negative ones too."""
    return F.col(ordinal) - F.pmod(F.col(ordinal), F.lit(block).cast("bigint"))


def _present(df: DataFrame, group: Sequence[str], ordinal: str) -> DataFrame:
    """Each (group, ordinal) once; repeats collapse before the shuffle."""
    return (
        df.filter(F.col(ordinal).isNotNull())
        .select(*group, F.col(ordinal).cast("bigint").alias(ordinal))
        .distinct()
    )


def missing_ranges(df: DataFrame, group: Sequence[str], ordinal: str, bounds: DataFrame | None = None) -> DataFrame:
    """C1, as ranges: group, first, last, n of each stretch of ordinals not present between the lowest and highest of the group.

    ``bounds`` (group columns, ``lo``, ``hi``) sets other limits, which may lie anywhere. A gap is one row however
    long it is: two ordinals of 1 and 10^16 give one row. Ordinals are laid in order and cut into ranges; each is
    compared with the next of its range, and only the first and last of a range meet those of other ranges.
    """
    keys = [f"g{i}" for i in range(len(group))]
    named = [F.col(c).alias(k) for c, k in zip(group, keys)]
    present = df.filter(F.col(ordinal).isNotNull()).select(*named, F.col(ordinal).cast("bigint").alias("at"))
    if bounds is not None:
        limits = bounds.select(*named, F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi"))
        limits = store(limits.filter("lo <= hi"), "bounds")
        # Fences just outside the limits; what they cut off beyond is clipped below.
        present = present.unionByName(limits.select(*keys, F.explode(F.array(F.col("lo") - 1, F.col("hi") + 1)).alias("at")))
    ranged = present.distinct().repartitionByRange(*[F.col(c) for c in [*keys, "at"]]).withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy(*keys, "range").orderBy("at")
    followed = ranged.withColumns({"next": F.lead("at").over(inside), "before": F.lag("at").over(inside)})
    at_edge = F.col("next").isNull() | F.col("before").isNull()
    followed = followed.withColumn("meet", F.when(at_edge, -1).otherwise(F.col("range")))
    meeting = Window.partitionBy(*keys, "meet").orderBy("at")
    followed = followed.withColumn("next", F.coalesce("next", F.lead("at").over(meeting)))
    gaps = followed.select(*keys, (F.col("at") + 1).alias("first"), (F.col("next") - 1).alias("last")).filter("first <= last")
    if bounds is not None:
        if keys:
            gaps = join_summary(gaps, limits, keys)
        else:
            only = limits.first()  # without a group there is one row of limits, or none
            gaps = gaps.withColumns({c: F.lit(only[c] if only else None).cast("bigint") for c in ("lo", "hi")}).filter(F.lit(only is not None))
        gaps = gaps.select(*keys, F.greatest("first", "lo").alias("first"), F.least("last", "hi").alias("last")).filter("first <= last")
    return gaps.select(
        *[F.col(k).alias(c) for c, k in zip(group, keys)], "first", "last", (F.col("last") - F.col("first") + 1).alias("n")
    )


def missing_ordinals(
    df: DataFrame,
    group: Sequence[str],
    ordinal: str,
    bounds: DataFrame | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Ordinals not present between the lowest and highest of each group, or within ``bounds``; see ``missing_ranges``.

    One row for each missing ordinal: ask for the ranges where gaps may be very long. A long gap is opened in steps
    of ``block``, each over new tasks, so no row ever lists more than ``block`` numbers.
    """
    gaps = missing_ranges(df, group, ordinal, bounds)
    names = [F.col(f"`{c}`") for c in group]
    first, last = F.col("first"), F.col("last")
    step = block**3
    while step >= 1:
        starts = F.sequence(first, last, F.lit(step).cast("bigint")) if step < 1 << 62 else F.array(first)
        opened = gaps.select(*names, last.alias("end"), F.explode(starts).alias("first"))
        end = F.when(F.col("end") - F.col("first") < step, F.col("end")).otherwise(F.col("first") + (step - 1)) if step < 1 << 62 else F.col("end")
        gaps, step = opened.select(*names, "first", end.alias("last")), step // block if step > 1 else 0
    return gaps.select(*names, F.col("first").alias(ordinal))


def _merged(pieces: DataFrame, within: Sequence[str], start: str, end: str, until: str) -> DataFrame:
    """Pieces that follow on each other, ``end`` + 1 being the next ``start``, as one: ``within``, ``start`` and its end ``until``.

    Only the first and last piece of a stretch are kept, and the first then takes the end of the row behind it. One
    sort serves both steps, and no task holds rows for an aggregation.
    """
    along = Window.partitionBy(*within).orderBy(start)
    opens, closes, behind = free_names([*within, start, end, until], "_opens", "_closes", "_behind")
    marked = pieces.withColumns(
        {
            opens: F.coalesce(F.lag(end).over(along) + 1 != F.col(start), F.lit(True)),
            closes: F.coalesce(F.lead(start).over(along) - 1 != F.col(end), F.lit(True)),
        }
    )
    ends = marked.filter(F.col(opens) | F.col(closes)).withColumn(behind, F.lead(end).over(along))
    return ends.filter(opens).select(*within, start, F.when(F.col(closes), F.col(end)).otherwise(F.col(behind)).alias(until))


def ordinal_islands(df: DataFrame, group: Sequence[str], ordinal: str, block: int = BLOCK) -> DataFrame:
    """Start, end and n of each unbroken stretch of ordinals.

    Stretches are found inside blocks; only those that touch the end of a block,
    at most two for each block, are put together across blocks.
    """
    start, end, until, low, meet = free_names(group, "_start", "_end", "_until", "_block", "_meet")
    present = _present(df, group, ordinal).select(*group, _block(ordinal, block).alias(low), F.col(ordinal).alias(start))
    pieces = _merged(present, [*group, low], start, start, end)
    at_edge = (F.col(start) == F.col(low)) | (F.col(end) == F.col(low) + (block - 1))
    pieces = pieces.withColumn(meet, F.when(~at_edge, F.col(low)))
    return _merged(pieces, [*group, meet], start, end, until).select(
        *group, F.col(start).alias("start"), F.col(until).alias("end"), (F.col(until) - F.col(start) + 1).alias("n")
    )


def misrouted(df: DataFrame, shard: str | Column, expected: Column) -> DataFrame:
    """C3, rows: those whose shard is not the one the rule gives; a null is a breach."""
    shard = F.col(shard) if isinstance(shard, str) else shard
    return df.filter(~F.coalesce(shard == expected, F.lit(False)))


def routing_check(df: DataFrame, shard: str, expected: Column) -> DataFrame:
    """Per shard, rows that keep and rows that break the routing rule.

    For blocks of a fixed ``stride``, the rule is ``floor(ordinal / stride)``.
    """
    kept = F.coalesce(F.col(shard) == expected, F.lit(False))
    return df.groupBy(shard).agg(F.count_if(kept).alias("n_kept"), F.count_if(~kept).alias("n_broken"))


def missing_shards(
    df: DataFrame, shard: str, total: str | Column, group: Sequence[str] = (), declared: DataFrame | None = None
) -> DataFrame:
    """C4: shards 0..total-1 of which no row exists; ``total`` is the highest declared.

    ``declared`` (group columns and ``total``) states the totals apart from the rows, so
    that a group without any row is missed too.
    """
    total = F.col(total) if isinstance(total, str) else total
    stated = df if declared is None else declared
    declared = stated.groupBy(*group).agg((F.max(total).cast("bigint") - 1).alias("hi"))
    bounds = declared.filter(F.col("hi") >= 0).withColumn("lo", F.lit(0).cast("bigint"))
    return missing_ordinals(df, group, shard, bounds=bounds)


def missing_shard_ranges(
    df: DataFrame, shard: str, total: str | Column, group: Sequence[str] = (), declared: DataFrame | None = None
) -> DataFrame:
    """C4, as ranges: group, first, last, n of each stretch of shards without a row; a total of any size is fine."""
    total = F.col(total) if isinstance(total, str) else total
    stated = df if declared is None else declared
    bounds = stated.groupBy(*group).agg((F.max(total).cast("bigint") - 1).alias("hi")).filter(F.col("hi") >= 0)
    return missing_ranges(df, group, shard, bounds=bounds.withColumn("lo", F.lit(0).cast("bigint")))


def shard_fill(df: DataFrame, shard: Sequence[str], stride: int) -> DataFrame:
    """Rows per shard and their share of ``stride``."""
    return df.groupBy(*shard).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) / F.lit(stride)).alias("fill")
    )


def size_cap_audit(
    df: DataFrame, group: Sequence[str], ordinal: str, cap: int, size: str = "size"
) -> DataFrame:
    """Last ordinal whose size is ``cap`` or more, and counts up to it and after it.

    ``n_after`` large with ``n_big_after`` 0, as it must be, points to a filter
    that began there. Groups with no such row have a null ordinal.
    """
    big = F.col(size) >= cap
    last_big = df.groupBy(*group).agg(F.max(F.when(big, F.col(ordinal))).alias("last_big_ordinal"))
    up_to = F.coalesce(F.col(ordinal) <= F.col("last_big_ordinal"), F.lit(False))
    return (
        join_summary(df.select(*group, ordinal, size), last_big, group)
        .groupBy(*group)
        .agg(
            F.max("last_big_ordinal").alias("last_big_ordinal"),
            F.count_if(up_to).alias("n_before"),
            F.count_if(up_to & big).alias("n_big_before"),
            F.count_if(~up_to).alias("n_after"),
            F.count_if(~up_to & big).alias("n_big_after"),
        )
    )
