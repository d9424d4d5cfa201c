"""Whitening, against dense linear algebra and exact arithmetic."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import queries, whitening

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def spd(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_inertia(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1, 0.0]:
            assert whitening.inertia_above(a, shift) == (values > shift).sum()
    assert whitening.inertia_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.inertia_above(np.zeros((3, 3)), 0.0) == 0


SPECTRA = {
    "falling": [2.0**-i for i in range(20)],
    "flat": [1 + 0.01 * i for i in range(40)],
    "crowded": [1 + 1e-6 * i for i in range(30)],
    "double": [5, 5, 3, 3, 3, 1, 1],
    "fourth double": [9, 8, 7, 5, 5, 1, 0.5],
    "all equal": [2.0] * 6,
    "rank two": [3, 1, 0, 0, 0, 0, 0, 0],
    "one": [4.0],
    "huge": [1e30, 1e28, 1e10, 1, 1],
    "tiny": [1e-30, 1e-31, 1e-32, 1e-33, 1e-34],
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("wanted", [1, 4])
def test_leading_components(name, wanted):
    matrix = spd(SPECTRA[name])
    matrix = (matrix + matrix.T) / 2
    dense = np.linalg.eigvalsh(matrix)[::-1]
    real = dense[dense > len(dense) * np.finfo(float).eps * dense[0]][:wanted]
    values, vectors = whitening.leading_components(matrix, wanted)
    assert len(values) == len(real)
    assert np.abs(values - real).max() <= 1e-13 * dense[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors.T - vectors.T * values, axis=0).max() <= 1e-13 * dense[0]


def test_nothing_to_find():
    for matrix in (np.zeros((0, 0)), np.zeros((3, 3))):
        values, vectors = whitening.leading_components(matrix, 4)
        assert len(values) == 0 and vectors.shape == (0, len(matrix))


def brute(rows, components=4):
    """(vec_id, component) -> n, deviation, whitened, explained by dense algebra and Python's whole numbers."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(x) for _, x in kept).items(), key=lambda p: p[::-1])[0]
    kept = [(i, x) for i, x in kept if len(x) == length]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [sum(col) for col in zip(*{tuple(x) for _, x in kept})]
    centred = fit - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        for k in range(min(components, length)):
            if values[k] > length * np.finfo(float).eps * values[0]:
                y = (np.array(x, float) - np.array([s / n for s in sums])) @ vectors[:, k] / math.sqrt(values[k])
                out.append((i, k + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), y, values[k] / np.trace(cov)))
    return out


def compare(found, expected):
    rows = [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in found.collect()]
    low = lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4]))
    rows, expected = sorted(rows, key=low), sorted(expected, key=low)
    assert [r[:4] for r in rows] == [r[:4] for r in expected]
    for k in {r[1] for r in rows}:
        a, b = (np.array([r[4] for r in side if r[1] == k]) for side in (rows, expected))
        assert np.abs(np.abs(a) - np.abs(b)).max() < 1e-8
        assert abs(abs(a @ b) - np.linalg.norm(a) * np.linalg.norm(b)) < 1e-8 * (1 + np.linalg.norm(a) ** 2)  # one sign for all rows
    assert [r[5] for r in rows] == pytest.approx([r[5] for r in expected], rel=1e-8)


def test_on_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    found = queries.op12_whitening(spark, FOLDER)
    compare(found, brute([(r.vec_id, r.embedding) for r in table.collect()]))
    assert found.agg(F.max("identity_error"), F.count_distinct("identity_error")).first()[0] < 1e-9


ODD = [
    (1, [0.5, 1.0, -2.0], 0), (1, [0.5, 1.0, -2.0], 0), (2, [0.5, 1.0, -2.0], 1), (3, [3.0, -1.0, 0.25], None),
    (None, [1.0, 1.0, 1.5], 0), (4, None, 0), (5, [], 0), (6, [None, 1.0, 2.0], 0), (7, [float("nan"), 1.0, 2.0], 0),
    (8, [float("inf"), 1.0, 2.0], 0), (9, [1.0, 2.0], 0), (10, [-0.0, 0.0, 0.001], 0), (11, [0.0, 0.0, -0.001], 0),
    (12, [4.0, 4.0, -7.0], 0),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    clashing = df.withColumns({c: F.lit("z") for c in ("x", "c", "n", "i", "component", "whitened", "part")})
    for one in (df, clashing, df.repartition(5)):
        compare(whitening.whiten(one), brute([r[:2] for r in ODD]))
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)).collect() == []


def test_copies_do_not_turn_components(spark):
    rows = [(i, list(map(float, v)), 0) for i, v in enumerate(np.random.default_rng(1).standard_normal((60, 6)))]
    hot = rows + [(1000 + i, rows[0][1], 0) for i in range(500)]
    compare(whitening.whiten(spark.createDataFrame(hot, SCHEMA)), brute([r[:2] for r in hot]))


def test_large_entries(spark):
    rows = [(i, [float(v) for v in x]) for i, x in enumerate([[1e17, 1.0], [-1e17, 2.0], [1e30, 3.0], [5.0, 1e16]])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.n for r in found} == {4} and all(r.deviation is None for r in found) and {r.vec_id for r in found} == {0, 1, 2, 3}
    near = [(0, [2e6, 9e5]), (1, [-1e6, 3e5]), (2, [3e6, -7e5])]
    compare(whitening.whiten(spark.createDataFrame(near, "vec_id bigint, embedding array<double>")), brute(near))
