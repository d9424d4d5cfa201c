"""Summaries that are stored, merged across loads and rolled up without the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe
from tallybook.functions.names import free_names
from tallybook.functions.storage import store

LG = 12  # 2^12 registers: a standard error of 1.04 / 64, 1.6 %


def distinct_sketches(df: DataFrame, group: Sequence[str], value: str, lg: int = LG) -> DataFrame:
    """Group, n_rows, sketch of the distinct non-null ``value`` of each group, of 2^lg registers at most.

    To be written as a table of its own: a load adds its rows to it, and nothing is read twice.
    """
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.col(value).cast("string"), lg).alias("sketch"))


def merge_distinct(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sketches of any loads and finer groups, merged to ``group``; the same as if built from all rows at once."""
    return sketches.groupBy(*group).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_of(sketches: DataFrame) -> DataFrame:
    """The estimate in place of the sketch, as ``n_distinct``."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def quantile_sketches(df: DataFrame, group: Sequence[str], value: str, k: int = 800) -> DataFrame:
    """Group, sketch of the non-null values (whole numbers) of each group: rank errors below 1 % at ``k`` 200, a quarter of that at 800.

    Tasks keep a sketch for each group and ship that, not rows; a group of any size is one sketch.
    """
    return df.groupBy(*group).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def merge_quantiles(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sketches of any loads and finer groups, merged to ``group``."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles_of(sketches: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """N and a column for each of ``points`` in place of the sketch; null for a group without values."""
    n = F.kll_sketch_get_n_bigint("sketch")
    at = {name: F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(point))) for name, point in points.items()}
    return sketches.withColumns({"n": n, **at}).drop("sketch")


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys, n of every combination of ``keys`` with more than ``share`` of all rows; exact, none is missed.

    A first pass keeps the most frequent hashes of keys in a summary of fixed size per task and merges them: whatever has the share
    is among them, as the summary's error is below half of it. A second pass counts the few candidates. Null is a value like others.
    """
    if not 0.0005 <= share <= 1:
        raise ValueError("a share from 0.0005 to 1")
    # Misra-Gries summaries of m items are off by 3.5 / m of the rows at most.
    most = 1 << max(6, math.ceil(math.log2(16 / share)))
    code = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys])
    found = df.select(code.alias("code")).agg(F.expr(f"approx_top_k(code, {most // 2}, {most})").alias("top"), F.count(F.lit(1)).alias("total"))
    row = store(found, "summary").first()  # ``most`` hashes at most
    likely = [x["item"] for x in row.top or [] if x["count"] >= (share / 2) * row.total]
    if not likely:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).limit(0)
    counted = df.filter(code.isin(likely)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > share * row.total)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = 0.01, salts: int = 16) -> DataFrame:
    """Inner join on ``keys`` in which the left side's heavy keys are dealt to ``salts`` tasks each.

    ``right`` is small for a heavy key: its rows of such keys are repeated ``salts`` times, all others once. Every pair comes
    once; null keys match nothing. The salt is a hash of the whole row, so a task run again deals alike. Both sides may have any columns; those of the right that are no keys must not repeat the left's.
    """
    salt, mark = free_names([*left.columns, *right.columns], "salt", "heavy")
    hot = store(heavy_hitters(left.dropna(subset=list(keys)), keys, share).select(*keys), "heavy")  # 1 / share rows at most
    flag = hot.withColumn(mark, F.lit(True))
    spread = F.when(F.col(mark), F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    a = join_null_safe(left, F.broadcast(flag), keys, "left").withColumn(salt, spread).drop(mark)
    copies = F.explode(F.when(F.col(mark), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    b = join_null_safe(right, F.broadcast(flag), keys, "left").withColumn(salt, copies).drop(mark)
    return a.join(b, [*keys, salt]).drop(salt)


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], sums: Sequence[str] = ()) -> DataFrame:
    """n_rows and sum of each of ``sums`` for each of several sets of keys, with ``set_no``, the place of the set in ``sets``.

    Keys outside a set are null. Rows are added up once, by all keys; every other set is summed from its smallest
    finer set, by counted rows, so no row is ever expanded and small sets cost next to nothing.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    totals = ["n_rows", *sums]
    done: dict[frozenset[str], tuple[DataFrame, int]] = {}

    def summed(source: DataFrame, by: Sequence[str]) -> DataFrame:
        return source.groupBy(*by).agg(*[F.sum(c).alias(c) for c in totals])

    whole = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in sums])
    whole = store(whole, "sums")
    done[frozenset(keys)] = (whole, whole.count())
    for wanted in sorted({frozenset(s) for s in sets}, key=len, reverse=True):
        if wanted not in done:
            parent = min((x for s, x in done.items() if wanted < s), key=lambda x: x[1])[0]
            table = store(summed(parent, [k for k in keys if k in wanted]), "sums")
            done[wanted] = (table, table.count())
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    parts = []
    for i, s in enumerate(sets):
        table = done[frozenset(s)][0]
        if not s:
            table = table.filter("n_rows IS NOT NULL")  # the sum over no rows at all
        columns = [F.col(k) if k in s else F.lit(None).cast(kinds[k]).alias(k) for k in keys]
        parts.append(table.select(F.lit(i).alias("set_no"), *columns, *totals))
    return reduce(DataFrame.unionByName, parts)


