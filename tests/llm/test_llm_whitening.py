"""Whitening against numpy's own eigenvectors and exact whole numbers."""

import math

import numpy as np
import pytest
from conftest import SF

from threadloom.llm import whitening
from threadloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def expected(rows):
    """Whole-number vectors by id, n, S and the covariance of the different ones."""
    x = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows]
    listed = sorted({v for _, v in x})
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    moved = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in listed])
    return x, n, sums, moved.T @ moved / n


def check(df, rows, components=16):
    x, n, sums, covariance = expected(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = [k for k in range(min(components, len(values))) if values[k] > 1e-12 * np.trace(covariance)]
    got = df.collect()
    assert len(got) == len(x) * len(found)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-9)
    want = {}
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        point = np.array([(n * c - s) / n for c, s in zip(v, sums)])
        want.setdefault(i, []).append((deviation, point @ vectors[:, : len(found)] / np.sqrt(values[found])))
    for k in found:
        gap = min([abs(values[k] - values[j]) for j in range(len(values)) if j != k], default=1)
        for r in by[k + 1]:
            assert any(r.deviation == d for d, _ in want[r.vec_id])
        if gap > 1e-6 * values[0]:
            ordered = lambda pairs: sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
            ours = ordered((r.vec_id, r.whitened) for r in by[k + 1])
            theirs = ordered((i, float(w[k])) for i, ws in want.items() for _, w in ws)
            flipped = ordered((i, -w) for i, w in theirs)
            close = lambda b: all(p[0] == q[0] and abs(p[1] - q[1]) < 1e-6 for p, q in zip(ours, b))
            assert close(theirs) or close(flipped)


@pytest.mark.parametrize("size", [1, 2, 3, 20, 64])
def test_eigenvectors(size):
    draw = np.random.default_rng(size)
    a = draw.normal(size=(size, size))
    near = np.diag([3.0, 3.0, 3.0 - 1e-14, 2, 1, 1][:size] + [0.5] * max(0, size - 6))
    turn = np.linalg.qr(a)[0]
    for matrix in (a @ a.T, a + a.T, np.eye(size), np.zeros((size, size)), turn @ near @ turn.T, np.diag(np.arange(size) * 1e-200)):
        values, vectors = whitening.leading_vectors(matrix, 16)
        k = min(size, 16)
        scale = np.abs(matrix).max() or 1
        assert np.allclose(values / scale, np.linalg.eigvalsh(matrix / scale)[::-1][:k], atol=1e-13 * size)
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
        assert np.abs(matrix / scale @ vectors - vectors * values / scale).max() < 1e-12 * size


def test_given_table(spark, table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    check(QUERIES["op13_whiten"](spark, SF), rows)


@pytest.mark.parametrize("size, count", [(3, 40), (20, 300)])
def test_copies_count_once(spark, size, count):
    draw = np.random.default_rng(count)
    some = draw.normal(size=(count, size)) @ draw.normal(size=(size, size))
    rows = [(int(i), [float(np.float32(c)) for c in some[i % (count // 2) if i % 3 else 0]]) for i in range(count)]
    check(whitening.whiten(spark.createDataFrame(rows, VECTORS)), rows)


def test_unusable_vectors(spark):
    good = [(i, [i / 64.0, (i * i % 7) / 64.0, 1.0]) for i in range(20)] + [(None, [0.5, 0.25, 1.0]), (3, [3 / 64.0, 2 / 64.0, 1.0])]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 1.0]), (54, [float("inf"), 0.0, 1.0]), (55, [1e30, 0.0, 0.0]), (56, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 1.5, "x") for r in good + odd], VECTORS + ", whitened double, x string")
    check(whitening.whiten(frame), good)  # the third dimension has no variance


def test_nothing_to_scale(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], VECTORS)).collect() == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**40 * i), float(i % 3)]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x, n, sums, _ = expected(rows)
    want = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in want.items()}
