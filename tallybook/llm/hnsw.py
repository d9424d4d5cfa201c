"""Nearest neighbours by a navigable small-world graph for each shard.

Distinct vectors are dealt to shards of about SHARD_ROWS. A shard's graph is a
stack of layers, each a flat array with a fixed number of neighbour places for each node; a
search goes greedily down the sparse layers and then keeps the ``ef`` best of
the lowest. Graphs are stored as a table of one row for each shard. Queries are dealt
in blocks to all shards, and a query's results of all shards are merged.

The search is approximate; distances are exact, in double precision on the
vectors as given. Every vector is indexed. Equal vectors are one node, which carries
the smallest ids, as many as a result can name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.storage import store

SHARD_ROWS = 8192
BLOCK_QUERIES = 8192  # with a shard, one task; a graph is sent once for each block, so about as many queries as a shard has rows
LINKS = 16  # of a node in an upper layer, and those a new node asks for; twice as many in the lowest
EF_BUILD = 64
EF_SEARCH = 192
WIDTH = 4  # nodes whose neighbours are looked at together


class Graph:
    """Vectors of one shard and, for each layer from the lowest up, its nodes' neighbours (-1: no more)."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None, height: np.ndarray | None = None, entry: int = 0):
        self.vectors, self.layers, self.height, self.entry = vectors, layers or [], height, entry
        self.seen = np.zeros(len(vectors) + 1, np.int64)
        self.turn = 0

    def distances(self, nodes: np.ndarray, to: np.ndarray) -> np.ndarray:
        away = self.vectors[nodes] - to
        return np.einsum("ij,ij->i", away, away)

    def search(self, to: np.ndarray, start: list[tuple[float, int]], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found from ``start`` (squared distance, node), nearest first."""
        self.turn += 1
        links, seen, turn = self.layers[layer], self.seen, self.turn
        todo, best = [], []
        for d, node in start:
            seen[node] = turn
            heappush(todo, (d, node))
            heappush(best, (-d, node))
        while todo:
            nodes = []
            while todo and len(nodes) < WIDTH and (len(best) < ef or todo[0][0] <= -best[0][0]):
                nodes.append(heappop(todo)[1])
            if not nodes:
                break
            near = np.unique(links[nodes])
            near = near[seen[near] != turn]  # place -1 stands for no neighbour
            seen[near] = turn
            near = near[near >= 0] if len(near) and near[0] < 0 else near
            if not len(near):
                continue
            away = self.distances(near, to)
            if len(best) >= ef:
                closer = away < -best[0][0]
                near, away = near[closer], away[closer]
            for x, n in zip(away.tolist(), near.tolist()):
                if len(best) < ef:
                    heappush(best, (-x, n))
                elif x < -best[0][0]:
                    heapreplace(best, (-x, n))
                else:
                    continue
                heappush(todo, (x, n))
        return sorted((-d, n) for d, n in best)

    def descend(self, to: np.ndarray, down_to: int) -> list[tuple[float, int]]:
        """The node nearest to ``to`` that greedy steps through the layers above ``down_to`` reach."""
        at = [(float(self.distances(np.array([self.entry]), to)[0]), self.entry)]
        for layer in range(len(self.layers) - 1, down_to, -1):
            at = self.search(to, at, 1, layer)
        return at

    def nearest(self, to: np.ndarray, k: int, ef: int) -> list[int]:
        """About the ``k`` nearest nodes; all of them if the graph gives fewer than there are."""
        found = [n for _, n in self.search(to, self.descend(to, 0), max(ef, k), 0)]
        if len(found) < min(k, len(self.vectors)):
            found = np.argsort(self.distances(np.arange(len(self.vectors)), to), kind="stable").tolist()
        return found[:k]


def _spread(graph: Graph, near: list[tuple[float, int]], most: int) -> list[tuple[float, int]]:
    """Up to ``most`` of the neighbours, nearest first: those nearer to the point than to one taken, then the rest."""
    if len(near) <= most:
        return near
    away = np.array([d for d, _ in near])
    points = graph.vectors[[n for _, n in near]]
    square = np.einsum("ij,ij->i", points, points)
    between = square[:, None] + square[None, :] - 2 * points @ points.T
    free, taken = np.ones(len(near), bool), []
    while len(taken) < most and free.any():
        i = int(free.argmax())
        taken.append(i)
        free[i] = False
        free &= between[i] > away
    rest = sorted(set(range(len(near))) - set(taken))
    return [near[i] for i in (taken + rest)[:most]]


def _link(links: np.ndarray, lengths: np.ndarray, node: int, new: int, away: float) -> None:
    """Adds a neighbour; a full node gives up its farthest one."""
    row = lengths[node]
    place = int(row.argmax())  # a free place is infinitely long
    if away < row[place]:
        links[node, place], row[place] = new, away


def build(vectors: np.ndarray, seed: int = 0, links: int = LINKS, ef: int = EF_BUILD) -> Graph:
    """The graph of a shard's vectors (float64 rows), which are inserted one after the other."""
    n = len(vectors)
    chance = np.random.default_rng(seed).random(n)
    height = np.minimum((-np.log(np.maximum(chance, 1e-12)) / math.log(links)).astype(int), 12)
    graph = Graph(vectors, height=height)
    if n:
        graph.layers = [np.full((n, 2 * links), -1, np.int32)]
    lengths = [np.full(layer.shape, np.inf) for layer in graph.layers]
    for node in range(1, n):
        to, top = vectors[node], int(height[node])
        at = graph.descend(to, min(top, len(graph.layers) - 1))
        for layer in range(min(top, len(graph.layers) - 1), -1, -1):
            at = graph.search(to, at, ef, layer)
            for away, other in _spread(graph, at, links):
                _link(graph.layers[layer], lengths[layer], node, other, away)
                _link(graph.layers[layer], lengths[layer], other, node, away)
        while len(graph.layers) <= top:
            graph.layers.append(np.full((n, links), -1, np.int32))
            lengths.append(np.full((n, links), np.inf))
            graph.entry = node
    return graph


def usable(vector: Column) -> Column:
    """Whether a vector takes part: present, not zero, all components finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(vector, lambda x: x != 0) & ~bad, F.lit(False))


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    plain = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return plain.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))


INDEX = "shard string, dim int, ids array<array<bigint>>, vectors binary, layers array<binary>, height binary, entry int"


def build_index(rows: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each shard: its nodes' ids (k + 1 smallest of equal vectors), vectors and flat neighbour arrays.

    Rows with a null id, or whose vector is null, empty, zero or has a null, infinite or NaN component, are left out. Repeated
    rows count once. Vectors of different lengths are in different shards. An empty table gives an empty index. Other
    columns are not looked at.
    """
    vectors = _vectors(rows, id_col, vector_col).distinct()
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = vectors.withColumn("place", first).filter(F.col("place") <= k + 1)
    nodes = store(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // SHARD_ROWS))
    dim = F.size("vector")
    placed = nodes.withColumn("shard", F.concat_ws("-", dim, F.pmod(F.xxhash64("vector"), F.lit(shards))))

    def run(table: pa.Table) -> pa.Table:
        lists = table.column("vector").combine_chunks()
        matrix = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False)).reshape(len(table), -1)
        order = np.lexsort(matrix.T[::-1])  # the same graph however the rows arrive
        matrix = matrix[order]
        graph = build(matrix)
        return pa.table({
            "shard": table.column("shard").slice(0, 1),
            "dim": pa.array([matrix.shape[1]], pa.int32()),
            "ids": pa.array([table.column("ids").take(pa.array(order)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([matrix.tobytes()], pa.binary()),
            "layers": pa.array([[layer.tobytes() for layer in graph.layers]], pa.list_(pa.binary())),
            "height": pa.array([graph.height.astype(np.int8).tobytes()], pa.binary()),
            "entry": pa.array([graph.entry], pa.int32()),
        })

    return store(placed.groupBy("shard").applyInArrow(run, INDEX), "index")


def _load(row: dict) -> Graph:
    vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    layers = [np.frombuffer(x, np.int32).reshape(len(vectors), -1) for x in row["layers"]]
    return Graph(vectors, layers, np.frombuffer(row["height"], np.int8), row["entry"])


def search(index: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF_SEARCH, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, by Euclidean distance.

    A query's own id is no candidate. Ties go to the smaller vec_id. With fewer
    candidates than ``k``, all are returned. Rows that take no part (null id; vector null, empty, zero, or
    with a null, infinite or NaN component) are neither queries nor candidates.
    A query meets candidates of its own dimension only. Rows that repeat an id and its vector
    count once; of an id with several vectors, each is searched for and found by itself, and the nearest stands.
    No queries or no candidates: no rows. Other columns are not looked at.
    """
    asked = _vectors(queries, id_col, vector_col).distinct().select(F.col("vec_id").alias("query_id"), "vector")
    shards = index.select("shard", F.col("dim"))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    # Each block of queries meets each shard of its dimension: a stated set against all rows, in blocks.
    places = store(shards.groupBy("dim").agg(F.collect_list("shard").alias("shards")), "shards")
    dealt = asked.withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks)).cast("int"))
    dealt = dealt.join(F.broadcast(places), "dim").select("query_id", "vector", "block", F.explode("shards").alias("shard"))
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        for row in left.to_pylist():
            graph = _load(row)
            asked = right.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, row["dim"])
            for query, to in zip(right.column("query_id").to_pylist(), asked):
                nodes = graph.nearest(to, k + 1, ef)
                away = graph.vectors[nodes] - to
                for node, score in zip(nodes, np.sqrt((away * away).sum(axis=1)).tolist()):
                    found += [(query, other, score) for other in row["ids"][node] if other != query]
        columns = zip(*found) if found else ([], [], [])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    hits = graphs.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(run, "query_id bigint, vec_id bigint, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
