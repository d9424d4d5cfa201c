"""Joins that keep to measured sizes and hold on hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.names import free_names
from tallybook.functions.storage import store

# A summary is sent to all executors only if it is counted and found this small.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null matches null; keys come from the left.

    Without keys everything matches: the right side is then a summary of one row.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    names = dict(zip(keys, free_names([*left.columns, *right.columns], *[f"_right_{k}" for k in keys])))
    marked = right.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(marked[names[k]]) for k in keys] or [F.lit(True)])
    joined = left.join(marked, condition, how)
    return joined.drop(*names.values())


def _width(field: T.StructField):
    """Bytes of one value: counted for text, by its JSON for nested data, else 8."""
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)):
        return F.length(F.to_json(F.struct(field.name)))
    return F.lit(8)


def _is_small(df: DataFrame) -> bool:
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins ``rows``, many to a key, with ``summary``, one to a key; null matches null.

    The summary is written first. Found small, it is broadcast and the rows are
    not shuffled at all. Otherwise both sides are shuffled; as a table of its own
    the summary then has an exchange right below the join, and only in that
    shape does AQE split the partition of a hot key. A summary still being
    aggregated in the stage of the join would rule that out.
    """
    summary = store(summary)
    if _is_small(summary):
        summary = F.broadcast(summary)
    return join_null_safe(rows, summary, keys, how)
