"""Entities, links between them, and repeatable splits and samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallybook.functions.hashing import hash_bucket, split_by_bucket
from tallybook.functions import joins
from tallybook.functions.joins import join_null_safe, join_summary
from tallybook.functions.ordering import first_n, running_total
from tallybook.functions.storage import store

# The usual three splits.
SPLIT_NAMES = ("train", "val", "test")
SPLIT_SHARES = (80, 10, 10)


def entity_hierarchy(df: DataFrame, parent: str, child: str, member: Sequence[str]) -> DataFrame:
    """G1: every (parent, child, member) row with ``member_no``, ``n_children`` and ``n_members``.

    Members are numbered from 1 through all children of a parent, in order of child and
    member; the counts are those of the whole parent. Long form, so a parent
    may have any number of members: numbers come range by range.
    """
    rows = df.select(parent, child, *member)
    order = [F.col(c) for c in [child, *member]]
    numbered = running_total(rows, [parent], order, total="member_no").withColumnRenamed("group_total", "n_members")
    children = rows.select(parent, child).distinct().groupBy(parent).agg(F.count(F.lit(1)).alias("n_children"))
    return join_summary(numbered, children, [parent])


def shared_children(df: DataFrame, parent: str, child: Sequence[str]) -> DataFrame:
    """Children found under several parents, with the number of parents."""
    return (
        df.filter(F.col(parent).isNotNull())
        .select(*child, parent)
        .distinct()
        .groupBy(*child)
        .agg(F.count(F.lit(1)).alias("n_parents"))
        .filter(F.col("n_parents") > 1)
    )


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.min(other).alias("_least"), F.count(F.lit(1)).alias("_n"))


def _links(df: DataFrame, member: str, via: str) -> DataFrame:
    """Edges (a, b), b < a, from each member to the least member that shares a ``via``.

    A star around the least member connects the same members as all their pairs
    would, with one edge for each row of the input.
    """
    rows = df.select(F.col(member).alias("a"), F.col(via).alias("_via")).dropna()
    shared = _least(rows, "_via", "a").filter(F.col("_n") > 1).drop("_n")
    return join_summary(rows, shared, ["_via"]).filter("_least < a").select("a", F.col("_least").alias("b")).distinct()


def _large_star(edges: DataFrame, join: Callable[..., DataFrame]) -> DataFrame:
    """Hangs each node below b on the least neighbour of b; the top of a star stays."""
    above = _least(edges, "a", "b").select(F.col("a").alias("b"), "_least")
    return join(edges, above, ["b"], "left").select("a", F.coalesce("_least", "b").alias("b")).distinct()


def _small_star(edges: DataFrame, join: Callable[..., DataFrame]) -> DataFrame:
    """Hangs each node and its smaller neighbours on the least of them."""
    joined = join(edges, _least(edges, "a", "b").drop("_n"), ["a"])
    below = joined.filter("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return below.unionByName(joined.select("a", F.col("_least").alias("b"))).distinct()


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple[int, object]]:
    """The edges as a table, with their number and checksum, which the write itself tells."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("checksum")
    table = store(edges.observe(seen, F.count(F.lit(1)).alias("n"), checksum), "edges")
    return table, (seen.get["n"], seen.get["checksum"])


def linked_groups(df: DataFrame, member: str, via: str) -> DataFrame:
    """Member, component (its least member) under links through shared ``via`` values.

    Connected components by alternating large-star and small-star steps
    (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014): a
    logarithmic number of rounds, where passing on the least label would take as
    many as the longest chain. A round is one job that writes the edges and sees whether they
    changed; few edges, by count, take both steps at once with plain joins, many are written between the steps. The
    rounds end when a round changes nothing.
    """
    edges, mark = _kept(_links(df, member, via))
    while mark[0]:
        if mark[0] <= joins.BROADCAST_ROWS:
            moved = _small_star(_large_star(edges, join_null_safe), join_null_safe)
        else:
            moved = _small_star(store(_large_star(edges, join_summary)), join_summary)
        edges, now = _kept(moved)
        if now == mark:
            break
        mark = now
    members = df.select(F.col(member).alias("a")).dropna().distinct()
    return members.join(edges, "a", "left").select(
        F.col("a").alias(member), F.coalesce("b", "a").alias("component")
    )


def group_split(
    df: DataFrame,
    key: str | Column,
    names: Sequence[str] = SPLIT_NAMES,
    shares: Sequence[int] = SPLIT_SHARES,
) -> DataFrame:
    """Adds ``bucket`` and ``split`` from the hash of the group key; rows stay where they are.

    Rows with a null key are one group and share a split.
    """
    bucket = hash_bucket(key, sum(shares))
    return df.withColumn("bucket", bucket).withColumn("split", split_by_bucket(F.col("bucket"), names, shares))


def split_leakage(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Group, split, n_rows, n_splits: a row for each split of every group that is in several.

    Any split names will do, and a null split is one of them. Rows are added up by group and split in the
    map tasks, so a group of any size costs a row for each of its splits.
    """
    counted = df.filter(F.col(group).isNotNull()).groupBy(group, split).agg(F.count(F.lit(1)).alias("n_rows"))
    n_splits = F.count(F.lit(1)).over(Window.partitionBy(group))
    return counted.withColumn("n_splits", n_splits).filter(F.col("n_splits") > 1)


def capped_sample(df: DataFrame, label: str, n: int, order: Sequence[str] = ("oid", "path")) -> DataFrame:
    """At most ``n`` rows per class, the first by content hash: repeatable and fair."""
    return first_n(df, [label], [F.col(c) for c in order], n)


def stratified_split(
    df: DataFrame,
    label: str,
    order: Sequence[str] = ("oid", "path"),
    names: Sequence[str] = SPLIT_NAMES,
    shares: Sequence[int] = SPLIT_SHARES,
) -> DataFrame:
    """Adds ``split`` (in place of a column of that name) with each class cut at the floor of the cumulative shares.

    Rows go by content hash (``order`` must break all ties), so copies of one oid
    are neighbours. Counts by the first three digits of the hash tell in which of
    4,096 slices of a class each cut falls. Rows of other slices are placed
    where they are, without a shuffle; only the slices with a cut are ranked,
    range by range, as one oid may fill a slice. ``order[0]`` must be a string of hex
    digits, as hashes are; rows without one come first in their class.
    """
    if df.schema[order[0]].dataType.simpleString() != "string":
        raise ValueError(f"{order[0]} must be a string of hex digits")
    whole, uppers = sum(shares), [sum(shares[: i + 1]) for i in range(len(shares))]
    # The table's own columns step aside under numbered names until the end.
    own = [c for c in df.columns if c.lower() != "split"]
    aside = [f"c{i}" for i in range(len(own))]
    known = dict(zip(own, aside))
    df, label, order = df.select(*[F.col(f"`{c}`").alias(known[c]) for c in own]), known[label], [known[c] for c in order]
    sliced = df.withColumn("_slice", F.coalesce(F.substring(order[0], 1, 3), F.lit("")))

    counts = sliced.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    of_class = Window.partitionBy(label)
    upto = of_class.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_total", F.sum("_n").over(of_class))

    def split_at(rank: Column) -> Column:
        chosen = None
        for name, upper in zip(names, uppers):
            inside = rank <= F.floor(F.col("_total") * upper / whole)
            chosen = F.when(inside, name) if chosen is None else chosen.when(inside, name)
        return chosen

    before = F.col("_end") - F.col("_n")
    slices = placed.select(
        label,
        "_slice",
        "_total",
        before.alias("_before"),
        split_at(before + 1).alias("_first"),
        split_at(F.col("_end")).alias("_last"),
    )
    # A slice is settled when its first and last row fall in the same split; the
    # settled slices of one split follow each other, and one slice at most runs
    # from a split into later ones.
    ends, settled_split, rows_before = [F.max("_total").alias("_total")], None, None
    for i, name in enumerate(names):
        begins = F.col("_first") == name
        mine, cut = begins & (F.col("_last") == name), begins & (F.col("_last") != name)
        ends += [
            F.min(F.when(mine, F.col("_slice"))).alias(f"_from_{i}"),
            F.max(F.when(mine, F.col("_slice"))).alias(f"_to_{i}"),
            F.max(F.when(cut, F.col("_slice"))).alias(f"_cut_{i}"),
            F.max(F.when(cut, F.col("_before"))).alias(f"_before_{i}"),
        ]
        inside = F.col("_slice").between(F.col(f"_from_{i}"), F.col(f"_to_{i}"))
        on_cut = F.col("_slice") == F.col(f"_cut_{i}")
        settled_split = F.when(inside, name) if settled_split is None else settled_split.when(inside, name)
        at = F.col(f"_before_{i}")
        rows_before = F.when(on_cut, at) if rows_before is None else rows_before.when(on_cut, at)

    columns = [*df.columns, "split"]
    planned = join_summary(sliced, slices.groupBy(label).agg(*ends), [label]).withColumn("split", settled_split)
    settled = planned.filter(F.col("split").isNotNull()).select(*columns)

    unsettled = planned.filter(F.col("split").isNull()).select(
        *df.columns, "_slice", "_total", rows_before.alias("_before")
    )
    ranked = running_total(unsettled, [label, "_slice"], [F.col(c) for c in order], total="_rank")
    decided = ranked.withColumn("split", split_at(F.col("_before") + F.col("_rank"))).select(*columns)
    return settled.unionByName(decided).withColumnsRenamed(dict(zip(aside, own)))
