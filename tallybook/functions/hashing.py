"""Repeatable pseudo-random choices from SHA-256; the same in any SQL engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_key(*cols: str | Column) -> Column:
    """One string for one or more key columns (``|`` between parts, nulls kept apart)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if len(parts) == 1:
        return F.coalesce(parts[0].cast("string"), F.lit("\u0000"))
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts])


def uniform_key(*cols: str | Column) -> Column:
    """64 hex digits, uniform over keys."""
    return F.sha2(as_key(*cols), 256)


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the key's SHA-256."""
    head = F.substring(uniform_key(key), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def split_by_bucket(bucket: Column, names: Sequence[str], shares: Sequence[int]) -> Column:
    """Name of the split whose share of 0..sum(shares)-1 holds the bucket."""
    if len(names) != len(shares):
        raise ValueError("one share for each split name")
    upper, chosen = 0, None
    for name, share in zip(names, shares):
        upper += share
        inside = bucket < F.lit(upper)
        chosen = F.when(inside, name) if chosen is None else chosen.when(inside, name)
    return chosen
