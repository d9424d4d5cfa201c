"""Whitening of embeddings on their leading principal components, found by FEAST.

Vectors are put on a grid of whole numbers, so that equal vectors, counts and sums are exact.
Tasks add up the centred products of the distinct vectors; what reaches the driver is one
matrix of d x d numbers for vectors of d entries, however many vectors there are.

Its leading eigenvectors come from contour integration. Inertia counts (signs of the
pivots of V - sI) tell how many eigenvalues lie above a shift without finding any, and so
place an interval that holds the wanted ones. A circle through the interval's ends is
walked by a quadrature rule: complex shifted solves project a random block on the
eigenvectors inside, a Rayleigh-Ritz step extracts them, and both are repeated until the
residuals vanish. The inertia count must then equal the number found, or the block grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store

SCALE = 256  # grid steps in 1
NODES = 8  # of the quadrature, on the upper half of the circle
MOST_ROUNDS = 60  # of one block size, before the block grows
MOST_DIMENSIONS = 8192  # entries of a vector; the driver holds a few matrices of that size squared (0.5 GB each)
MERGED = 64  # partial sums are merged in so many groups first


# --- eigenvectors -------------------------------------------------------------


def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: the positive pivots of matrix - shift I.

    Diagonal pivoting with 1 x 1 and 2 x 2 pivots (Bunch and Parlett), stable for any shift; a 2 x 2
    pivot is taken only where it has one eigenvalue of either sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    above, alpha = 0, (1 + math.sqrt(17)) / 8
    while len(a):
        n = len(a)
        size = np.abs(a)
        r = int(np.argmax(size.diagonal()))
        off = size.copy()
        np.fill_diagonal(off, 0.0)
        p, q = divmod(int(np.argmax(off)), n)
        if size[r, r] == 0 and off[p, q] == 0:
            return above  # the rest is zero: eigenvalues equal to the shift
        if size[r, r] >= alpha * off[p, q]:
            above += bool(a[r, r] > 0)
            rest = np.delete(np.arange(n), r)
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[r, r])
        else:
            above += 1
            rest = np.delete(np.arange(n), [p, q])
            pair = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - pair @ np.linalg.solve(a[np.ix_([p, q], [p, q])], pair.T)
        a = (a + a.T) / 2
    return above


def leading_interval(matrix: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """(low, high, count): an interval with the ``wanted`` largest eigenvalues above ``low`` and none above ``high``.

    ``count`` of them are inside; more than wanted only where eigenvalues nearly equal the last one.
    The ends stay away from eigenvalues: ``low`` is the middle of the widest gap found below the last wanted one.
    """
    bound = float(np.abs(matrix).sum(axis=1).max())
    tiny = bound * len(matrix) * np.finfo(float).eps

    def last_above(least: int) -> tuple[float, float]:
        """Brackets the ``least``-th largest eigenvalue: at least that many above the first, fewer above the second."""
        low, high = -tiny - bound * 1e-3, bound * 1.001 + tiny
        while high - low > 1e-3 * max(high, 0.0) + tiny:
            middle = (low + high) / 2
            if inertia_above(matrix, middle) >= least:
                low = middle
            else:
                high = middle
        return low, high

    low, _ = last_above(wanted)
    _, high = last_above(1)
    if wanted < len(matrix):
        _, under = last_above(wanted + 1)
        if under < low:
            low = (low + under) / 2
    return low, high + (high - low) * 0.05 + tiny, inertia_above(matrix, low)


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block times a filter that is near 1 on eigenvalues between ``low`` and ``high`` and near 0 outside.

    Gauss quadrature of (1 / 2 pi i) times the integral of (zI - V)^-1 over the circle with the interval as diameter.
    As V and the block are real, the upper half of the circle tells the lower one.
    """
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    for x, w in zip(points, weights):
        turn = np.exp(1j * math.pi / 2 * (x + 1))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block)
        out += (w / 2) * (radius * turn * solved).real
    return out


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of a symmetric matrix between ``low`` and ``high``, falling, and their unit vectors (columns).

    The block has room for neighbours outside, grows if the result does not settle or the count is not met,
    and is the whole space at last.
    """
    n = len(matrix)
    # Rounding leaves residuals of a few times this size.
    small = 8 * np.finfo(float).eps * max(float(np.abs(matrix).sum(axis=1).max()), np.finfo(float).tiny)
    random = np.random.default_rng(12)
    width = min(n, 2 * count + 8)
    while True:
        block, before = random.standard_normal((n, width)), math.inf
        for _ in range(MOST_ROUNDS):
            basis = np.linalg.qr(project(matrix, block, low, high))[0]
            values, inner = np.linalg.eigh(basis.T @ matrix @ basis)  # Rayleigh-Ritz in the small space
            block = basis @ inner
            inside = (values > low) & (values < high)
            worst = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0.0)
            if int(inside.sum()) == count and (worst <= small or (worst <= 64 * small and worst >= before / 2)):
                order = np.argsort(-values[inside], kind="stable")
                return values[inside][order], block[:, inside][:, order]
            before = worst
        if width == n:
            raise ArithmeticError(f"{int(inside.sum())} eigenvalues found between {low} and {high}, {count} counted")
        width = min(n, 2 * width)


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and their unit vectors (rows), each with its largest entry positive."""
    if not len(matrix) or not wanted or not np.abs(matrix).max() > 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    unit = float(np.abs(matrix).max())  # so that neither tiny nor huge numbers matter
    low, high, count = leading_interval(matrix / unit, min(wanted, len(matrix)))
    values, vectors = feast(matrix / unit, low, high, count)
    real = values > len(matrix) * np.finfo(float).eps * values[0]
    values, vectors = values[real][:wanted] * unit, vectors.T[real][:wanted]
    peaks = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)] if len(vectors) else np.zeros(0)
    return values, vectors * np.sign(peaks)[:, None]


# --- sums over all vectors ------------------------------------------------------


def _grid(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """Rows of whole numbers from a column of lists of one length."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _added(partials: DataFrame) -> DataFrame:
    """(i, v) with lists ``v`` added entry by entry, in two levels so that no task holds all partial sums of a key."""

    def add(table: pa.Table) -> pa.Table:
        chunks = table.column("v").combine_chunks()
        total = np.asarray(chunks.flatten()).reshape(len(chunks), -1).sum(axis=0)
        return pa.table({"i": table.column("i")[:1], "v": pa.array([total], pa.list_(pa.float64()))})

    first = partials.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGED)))
    return first.groupBy("i", "part").applyInArrow(add, "i int, v array<double>").groupBy("i").applyInArrow(add, "i int, v array<double>")


@dataclass(frozen=True)
class Whitening:
    """What is known of the distinct vectors: count, sum of each entry, eigenvalues, components (rows), trace, identity error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def scores(self, grid: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of whole numbers."""
        centre = np.array([s / self.n for s in self.sums])
        return (grid - centre) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """Sum over entries of (n x - S)^2, exact; None beyond 64 bits."""
        if not grid.size:
            return [0] * len(grid)
        most = self.n * int(max(abs(int(grid.min())), abs(int(grid.max())))) + max(map(abs, self.sums))
        if len(self.sums) * most * most < 1 << 63:
            return ((self.n * grid - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * grid.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(x) if x < 1 << 63 else None for x in exact]


def on_grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x = floor(256 c) of the rows whose vector has only finite entries, all of the table's length.

    The table's length is the most frequent one (of ties, the largest); other lengths, and empty vectors, take no part.
    Entries beyond the range of a long stop at its ends.
    """
    c = F.col("c")
    finite = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    plain = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    plain = plain.filter(c.isNotNull() & (F.size(c) > 0)).filter(finite)
    lengths = plain.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    dimension = lengths.d if lengths else 0
    if dimension > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dimension} entries; {MOST_DIMENSIONS} at most")
    return plain.filter(F.size("c") == dimension).select("vec_id", F.transform("c", lambda e: F.floor(e * SCALE)).alias("x"))


def fit(grid: DataFrame, components: int) -> Whitening | None:
    """Learns the whitening from the distinct vectors ``x`` of ``grid``; None without rows.

    The distinct vectors are written once and read three times: for sums, for products, for the check.
    """
    points = store(grid.select("x").distinct(), "points")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _grid(batch, 0)
            if len(x):
                safe = int(max(abs(int(x.min())), abs(int(x.max())))) * len(x) < 1 << 63
                part = [int(s) for s in (x if safe else x.astype(object)).sum(axis=0)]
                n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([list(map(str, total))], pa.list_(pa.string()))], names=["n", "s"]
            )

    partial = store(points.mapInArrow(add_up, "n bigint, s array<string>"), "sums")
    n = partial.agg(F.sum("n")).first()[0]
    if not n:
        return None
    summed = partial.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = tuple(int(r.s) for r in summed.orderBy("i").collect())  # one number for each entry of a vector
    centre, d = np.array([s / n for s in sums]), len(sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _grid(batch, 0)
            if len(x):
                x = x - centre
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"]
        )

    # d rows of d numbers.
    rows = _added(store(points.mapInArrow(products, "i int, v array<double>"), "products")).orderBy("i").collect()
    matrix = np.array([r.v for r in rows]) / n
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading_components(matrix, components)
    found = Whitening(n, sums, values, vectors, float(np.trace(matrix)), 0.0)
    k = len(values)
    if not k:
        return found

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            x = _grid(batch, 0)
            if len(x):
                y = found.scores(x)
                total += np.vstack([y.T @ y, y.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k + 1, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"]
        )

    rows = _added(store(points.mapInArrow(check, "i int, v array<double>"), "check")).orderBy("i").collect()
    seen = np.array([r.v for r in rows]) / n
    error = np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max()
    return Whitening(n, sums, values, vectors, found.trace, float(error))


OUTPUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def apply(grid: DataFrame, known: Whitening) -> DataFrame:
    """vec_id and OUTPUT: a row for each row of ``grid`` and component."""
    k = len(known.values)
    explained = known.values / known.trace if k else known.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _grid(batch, 1)
            rows = len(x)
            if not rows or not k:
                continue
            deviation = pa.array(known.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, known.n)),
                    deviation.take(each),
                    pa.array(known.scores(x).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, known.identity_error)),
                ],
                names=["vec_id", *[f.split()[0] for f in OUTPUT.split(", ")]],
            )

    return grid.mapInArrow(run, f"vec_id {grid.schema['vec_id'].dataType.simpleString()}, {OUTPUT}")


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: each vector on the leading components.

    Entries c become x = floor(256 c). Every distinct x counts once in sums and covariance (divisor n), so
    copies of a vector, however many, do not turn the components. ``deviation`` is the sum over entries of
    (n x - S)^2 (null beyond 64 bits), ``whitened`` the centred x on the unit component over the root of its eigenvalue,
    ``explained`` the eigenvalue's share of the trace, ``identity_error`` the largest entry of the whitened
    vectors' covariance less the identity.

    Vectors that are null, empty, of another length than most, or have a null or non-finite entry give no row. Every
    other row gives its rows, repeated rows and null ids too. Components with an eigenvalue of zero (fewer distinct vectors than
    components, or a constant table) are left out; a table with fewer entries than components has as many as entries.
    Equal eigenvalues are taken in either order. An empty table gives an empty result. Other columns are not looked at.
    """
    grid = on_grid(vectors, id_col, vector_col)
    known = fit(grid, components)
    if known is None:
        known = Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    return apply(grid, known)
