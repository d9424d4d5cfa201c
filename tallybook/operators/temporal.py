"""Joins on time. Ordered work by ranges, intervals by nested bins; no pair of rows is tried in vain for its time alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.joins import join_null_safe, join_summary
from tallybook.functions.storage import store


def _out(packed: str, names: Sequence[str], prefix: str = "") -> list[Column]:
    return [F.col(packed)[name].alias(prefix + name) for name in names]


def _check_names(left: DataFrame, right: DataFrame, prefix: str) -> None:
    clash = {c.lower() for c in left.columns} & {(prefix + c).lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides would give columns {sorted(clash)}; choose another prefix")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    tie: Sequence[str] = (),
    strict: bool = False,
    prefix: str = "right_",
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time (before, if ``strict``).

    Columns of the right side come with ``prefix``, null where there is no such row. Of right rows with
    equal key and time the last by ``tie`` is taken. Null keys and times match nothing; every left row gives one row.

    Both tables are laid in one order and cut into ranges of (key, time), so a key with a third of all rows
    is many ranges. Inside a range the last right row is carried along by a window; what a range hands on to
    the next is one row for each key that goes on in it. Only such keys, two for each range at most,
    are looked at a second time. No pairs of rows are formed.
    """
    _check_names(left, right, prefix)
    keys = [f"k{i}" for i in range(len(by))]
    order = ["t", "side", *[f"o{i}" for i in range(len(tie))]]
    right_type = right.schema.simpleString()
    left_type = left.schema.simpleString()
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, right_time]])
    # At one time, right rows stand before left ones, or after them if they must be strictly earlier.
    rows = left.select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        F.col(left_time).alias("t"),
        F.lit(1).alias("side"),
        *[F.lit(None).cast(right.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(tie)],
        F.struct(*[F.col(c) for c in left.columns]).alias("l"),
        F.lit(None).cast(right_type).alias("r"),
    ).unionByName(
        right.filter(known).select(
            *[F.col(b).alias(k) for b, k in zip(by, keys)],
            F.col(right_time).alias("t"),
            F.lit(2 if strict else 0).alias("side"),
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(tie)],
            F.lit(None).cast(left_type).alias("l"),
            F.struct(*[F.col(c) for c in right.columns]).alias("r"),
        )
    )
    ranged = rows.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).withColumn("range", F.spark_partition_id())
    ranged = store(ranged, "ranges")  # pins which row is in which range

    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    ends = ranged.groupBy("range").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("ends"))
    going_on = ends.select("range", F.explode("ends").alias("key")).groupBy("key").count().filter("count > 1")
    going_on = going_on.select(*[F.col("key")[k].alias(k) for k in keys])  # two for each range at most
    handed = join_null_safe(ranged.filter("r is not null"), F.broadcast(going_on), keys, "left_semi") if keys else ranged.filter("r is not null")
    handed = handed.groupBy(*keys, "range").agg(F.max_by("r", F.struct(*order)).alias("last"))
    # A range of such a key may hold left rows only, so all its ranges are laid out before the rows are carried.
    spans = join_null_safe(ranged.select(*keys, "range"), F.broadcast(going_on), keys, "left_semi") if keys else ranged.select("range")
    spans = join_null_safe(spans.distinct(), handed, [*keys, "range"], "left")
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(*keys, "range", F.last("last", ignorenulls=True).over(earlier).alias("start"))

    along = Window.partitionBy(*keys, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.withColumn("found", F.last("r", ignorenulls=True).over(along)).filter("l is not null")
    joined = join_summary(inside, starts.filter("start is not null"), [*keys, "range"], "left")
    joined = joined.select("l", F.coalesce("found", "start").alias("r"))
    return joined.select(*_out("l", left.columns), *_out("r", right.columns, prefix))


def _ticks(df: DataFrame, name: str) -> Column:
    """A time or a whole number as a long; microseconds for times."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("bigint")


def _cover(first: Column, last: Column) -> Column:
    """Nodes (level, node) that together cover bins ``first`` to ``last`` once: two for each level at most.

    Node n of level k stands for the bins n 2^k to (n + 1) 2^k - 1. A node is taken if it is wholly inside while its parent is not.
    """

    def of_level(level: Column) -> Column:
        up = lambda x: F.call_function("shiftright", x, level)
        low, high = -up(-first), up(last + 1)
        node = lambda n, here: F.when((low < high) & here, F.struct(level.alias("level"), n.alias("node")))
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        return F.array(node(low, odd(low)), node(high - 1, odd(high)))

    levels = F.sequence(F.lit(0), F.length(F.bin(last - first + 1)))
    return F.filter(F.flatten(F.transform(levels, of_level)), lambda n: n.isNotNull())


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
    prefix: str = "right_",
) -> DataFrame:
    """Pairs of rows with equal keys whose half-open intervals [start, end) overlap.

    ``width`` is the length of a bin, in microseconds for times; about that of a usual interval. Any width gives the
    same pairs. Empty intervals and those with a null end overlap nothing; null keys match nothing.

    Two intervals overlap where the one that starts later starts inside the other; so each pair is found once,
    by the later start (of equal starts, the right one). An interval is cut at bin edges into nodes of nested
    bins, at most two for each doubling of its length, so a long interval is a few dozen nodes and not millions
    of bins. A start looks for the nodes above its bin, on those levels that occur. The join is on (key, level,
    node), a hot key being spread over its nodes.
    """
    _check_names(left, right, prefix)
    keys = [f"k{i}" for i in range(len(by))]

    def packed(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        start, end = _ticks(df, span[0]), _ticks(df, span[1])
        found = df.select(
            *[F.col(b).alias(k) for b, k in zip(by, keys)], start.alias("s"), end.alias("e"),
            F.struct(*[F.col(c) for c in df.columns]).alias(name),
        )
        return found.filter("s < e").dropna(subset=keys) if keys else found.filter("s < e")

    def number(tick: Column) -> Column:
        whole = tick - F.pmod(tick, F.lit(width).cast("bigint"))
        return F.call_function("div", whole, F.lit(width).cast("bigint"))

    def within(whole: DataFrame, name: str, points: DataFrame, point: str, closed: bool) -> DataFrame:
        """Pairs in which the point's start is in the interval of ``whole``; its start included if ``closed``."""
        nodes = whole.select("*", F.explode(_cover(number(F.col("s")), number(F.col("e") - 1))).alias("n"))
        nodes = store(nodes.select(*keys, "s", "e", name, "n.level", "n.node"), "nodes")
        levels = [r.level for r in nodes.select("level").distinct().collect()]  # 64 at most
        if not levels:
            levels = [0]
        above = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(number(F.col("s")), k).alias("node")) for k in sorted(levels)]))
        seek = points.select(*keys, F.col("s").alias("at"), point, above.alias("n")).select(*keys, "at", point, "n.level", "n.node")
        met = nodes.join(seek, [*keys, "level", "node"])
        return met.filter((F.col("s") <= F.col("at") if closed else F.col("s") < F.col("at")) & (F.col("at") < F.col("e")))

    a, b = packed(left, left_span, "l"), packed(right, right_span, "r")
    pairs = within(a, "l", b, "r", True).select("l", "r").union(within(b, "r", a, "l", False).select("l", "r"))
    return pairs.select(*_out("l", left.columns), *_out("r", right.columns, prefix))
