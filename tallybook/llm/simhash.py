"""Near copies by SimHash, found with a hierarchical index in Gray order.

Fingerprints are made where the texts are. The distinct ones are dealt to
groups so that any two within the distance meet in a group: the bits are cut into
blocks, and a group holds all fingerprints that agree in a choice of blocks.
Inside a group the fingerprints are sorted by Gray rank, so neighbours share most
bits. Each node of the hierarchy above holds the bits its members have in common
and where; two nodes are compared by the differing bits among those common to
both, which already accumulates the differences of all levels above, and a pair
of nodes beyond the distance is dropped with all its members. Only links that join
something new leave the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store
from tallybook.llm.common import components, connected, decide, words_of

SEED = 42
GROUP_ROWS = 4096  # aimed at for each group; the work of a group grows with its square
SLICE_ROWS = 16384  # a larger group is cut into slices, and each two slices are compared in a task
FANOUT = 8
PAIRS = 1 << 20  # node pairs compared at once


def fingerprint(text: bytes | None, shingle: int, slab: int = 1 << 15) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    flat, size = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), slab):
        hashes = np.array([digest(flat[s:e], SEED) for s, e in zip(starts[i : i + slab], ends[i : i + slab])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, fp bigint")


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the reflected Gray code."""
    rank = prints.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


def _hierarchy(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the root down, each with the common bits and the mask of where they are common."""
    ones, zeros = prints, ~prints
    levels = [(prints, ~np.zeros_like(prints))]
    while len(ones) > 1:
        cuts = np.arange(0, len(ones), FANOUT)
        ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)
        levels.append((ones, ones | zeros))
    return levels[::-1]


def near_pairs(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of sorted ``prints`` at most ``distance`` bits apart, a slab at a time."""
    levels = _hierarchy(prints)
    todo = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))] if len(prints) > 1 else []
    while todo:
        level, a, b = todo.pop()
        if level == len(levels) - 1:
            yield a, b
            continue
        bits, mask = levels[level + 1]
        n, per = len(bits), PAIRS // FANOUT**2
        for i in range(0, len(a), per):
            kids = np.arange(FANOUT)
            x = (a[i : i + per, None, None] * FANOUT + kids[:, None] + 0 * kids).ravel()
            y = (b[i : i + per, None, None] * FANOUT + 0 * kids[:, None] + kids).ravel()
            fits = (x < n) & (y < n) & ((x < y) if level + 1 == len(levels) - 1 else (x <= y))
            x, y = x[fits], y[fits]
            apart = np.bitwise_count((bits[x] ^ bits[y]) & mask[x] & mask[y])
            close = apart <= distance
            if close.any():
                todo.append((level + 1, x[close], y[close]))


def spanning_links(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``near_pairs`` connects, one for each point but the smallest of its component."""
    prints = prints[np.argsort(gray_rank(prints), kind="stable")]
    label = np.arange(len(prints))
    for a, b in near_pairs(prints, distance):
        la, lb = label[a], label[b]
        new = la != lb
        if new.any():
            label = connected(len(prints), la[new], lb[new])[label]
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[moved], prints[label[moved]]


def _block_masks(n: int, distance: int) -> list[int]:
    """Masks of bits; any two fingerprints within the distance agree under one of them.

    More blocks, thus longer keys and more copies of a row, for more
    fingerprints; the links found are the same for any choice.
    """
    blocks = distance + 1
    while blocks < distance + 4 and n / 2 ** (64 * (blocks - distance) / blocks) > GROUP_ROWS:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def near_links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """a, b: links that connect all distinct fingerprints ``fp`` joined by steps of at most ``distance`` bits.

    ``prints`` holds each fingerprint once and no null. An empty table, or one fingerprint, has no links. Of equally good links any one
    stands. Other columns are not looked at.
    """
    if not 0 <= distance < 32:
        raise ValueError("the distance must be from 0 to 31 bits")
    n = prints.count()
    masks = [m - (1 << 64) if m >> 63 else m for m in _block_masks(n, distance)]
    groups = max(1, n // GROUP_ROWS)
    choices = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("bigint").alias("m")) for i, m in enumerate(masks)]))
    dealt = prints.select("fp", choices.alias("c")).select(
        "fp", F.concat_ws("-", "c.i", F.pmod(F.xxhash64(F.col("fp").bitwiseAND(F.col("c.m"))), F.lit(groups))).alias("key")
    )
    dealt = store(dealt, "dealt")
    large = dealt.groupBy("key").count().filter(F.col("count") > SLICE_ROWS)
    large = large.select("key", F.ceil(F.col("count") / SLICE_ROWS).cast("int").alias("slices"))
    # Each two slices of a large group meet once, also a slice with itself.
    own = F.pmod(F.hash("fp"), F.coalesce("slices", F.lit(1)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))
    placed = dealt.join(large, "key", "left").select("fp", "key", own.alias("own"), other.alias("other"))
    placed = placed.select("fp", F.concat_ws("-", "key", F.least("own", "other"), F.greatest("own", "other")).alias("key"))

    def run(table: pa.Table) -> pa.Table:
        found = spanning_links(table.column("fp").to_numpy().view("u8"), distance)
        return pa.table([pa.array(x.view("i8"), pa.int64()) for x in found], names=["a", "b"])

    return placed.groupBy("key").applyInArrow(run, "a bigint, b bigint")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fp, root, component_id of each row of ``docs``.

    Rows link when their fingerprints differ in at most ``distance`` bits.
    ``root`` names the component (its smallest fingerprint as a signed long), ``component_id`` is
    its smallest doc_id. Null and empty texts, and texts of white space, have
    fingerprint zero and link like any other; repeated rows stay repeated; a null
    doc_id never is the smallest unless a component has no other. Other columns are
    not looked at. An empty table gives an empty result.
    """
    rows = store(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    prints = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    roots = components(near_links(prints.select("fp"), distance))
    placed = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    placed = store(placed, "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = store(placed.join(least, "root").select("fp", "root", "component_id"), "members")
    return rows.join(members, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest doc_id.

    Of several rows with that id, one of those with the smallest fingerprint stays.
    """
    found = near_copies(docs, id_col, text_col, shingle, distance)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(F.min("fp").alias("fp"))
    # Ids are enough where they are unique; the few that repeat are settled by their text's fingerprint.
    kept = store(kept.select(F.col("doc_id").alias(id_col), "fp"), "kept")
    chosen = decide(docs, kept.select(id_col).distinct(), [id_col], "left_semi")
    repeated = store(docs.groupBy(id_col).count().filter("count > 1").select(id_col), "repeated")
    if repeated.isEmpty():
        return chosen
    once = decide(chosen, repeated, [id_col], "left_anti")
    again = decide(chosen, repeated, [id_col], "left_semi")
    return once.unionByName(_one_each(again, kept, id_col, text_col, shingle))


def _one_each(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """One row of ``docs`` for each (id, fingerprint) of ``kept``."""
    whole = docs.withColumn("_row", F.struct(*[F.col(c) for c in docs.columns]))
    text_at, schema = whole.columns.index(text_col), f"fp bigint, _row {whole.schema['_row'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), batch.column("_row")], names=["fp", "_row"])

    marked = whole.mapInArrow(run, schema).select(F.col(f"_row.`{id_col}`").alias("_id"), "fp", "_row")
    single = marked.groupBy("_id", "fp").agg(F.first("_row").alias("_row"))
    wanted = kept.select(F.col(id_col).alias("_k"), F.col("fp").alias("_fp")).distinct()
    return single.join(wanted, F.col("_id").eqNullSafe(F.col("_k")) & (F.col("fp") == F.col("_fp")), "left_semi").select("_row.*")
