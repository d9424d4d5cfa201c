"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe
from tallybook.functions.storage import store

# A side of a join is sent to every executor only if it was counted and found this small.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; none for null or empty text."""
    return text.lower().split() if text else []


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def decide(docs: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Joins ``docs`` with a stored table of one row per key.

    The table is counted first. Small enough, it is broadcast and the texts stay
    where they are; beyond the bound both sides are shuffled and AQE splits hot keys.
    Null matches null.
    """
    keys = store(keys, "decisions")
    wide = 16 * len(keys.columns) + 16
    if keys.limit(min(BROADCAST_ROWS, BROADCAST_BYTES // wide) + 1).count() <= min(BROADCAST_ROWS, BROADCAST_BYTES // wide):
        keys = F.broadcast(keys)
    return join_null_safe(docs, keys, on, how)


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` points' component under links a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of edges (a, b), longs.

    Alternates two star operations until no edge changes: each node hands its
    larger neighbours to its smallest one, then its smaller ones. That takes
    about log(n) rounds and keeps at most one edge for each node pair seen; a
    node's neighbours are never gathered, only their minimum is.
    """
    links = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = store(_star(both, "b > a"), "links")  # larger neighbours to the smallest of all
        links = store(_star(links, "true"), "links")  # smaller neighbours and the node itself to the smallest
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _star(links: DataFrame, handed: str) -> DataFrame:
    """Each node's neighbours that meet ``handed``, and the node, linked to its smallest neighbour or itself."""
    low = links.groupBy("a").agg(F.min("b").alias("_low")).select(F.col("a").alias("_a"), F.least("a", "_low").alias("_low"))
    joined = links.join(low, links.a == low._a)
    moved = joined.filter(handed).select(F.col("b").alias("x"), "_low")
    own = low.select(F.col("_a").alias("x"), "_low")
    return (
        moved.union(own)
        .filter("x <> _low")
        .select(F.greatest("x", "_low").alias("a"), F.least("x", "_low").alias("b"))
        .distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Count and checksum of the links, to see whether a round changed them."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
