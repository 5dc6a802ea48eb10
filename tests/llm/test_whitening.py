"""Whitening against NumPy's eigenvectors of the covariance, and the bidiagonal solver against its SVD."""

import numpy as np
import pytest

from weftline.llm import singular, whitening
from weftline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, n int, `a.b` int"


def expected(data, count=4):
    """(id, component) -> n, deviation, whitened up to sign, explained."""
    good = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in data if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dims = max(map(len, (v for _, v in good)), default=0)
    good = [(i, tuple(v + [0] * (dims - len(v)))) for i, v in good]
    listed = sorted({v for _, v in good})
    n, sums = len(listed), [sum(v[k] for v in listed) for k in range(dims)]
    x = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in listed])
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, v in good:
        row = np.array([(n * a - s) / n for a, s in zip(v, sums)])
        for k in range(min(count, int((values > 1e-12 * values[0]).sum()))):
            out.append((i, k + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), float(row @ vectors[:, k] / np.sqrt(values[k])), float(values[k] / values.sum())))
    return out


def order(x):
    return x[0] is None, x[0] or 0, x[1], x[3]


def check(found, want):
    signs = {}
    for got, ref in zip(sorted(map(tuple, found), key=order), sorted(want, key=order), strict=True):
        assert got[:4] == ref[:4]
        if abs(ref[4]) > 1e-6:
            signs.setdefault(got[1], np.sign(got[4] * ref[4]))
        assert got[4] == pytest.approx(signs.get(got[1], 1) * ref[4], abs=1e-9)
        assert got[5] == pytest.approx(ref[5], rel=1e-9) and got[6] < 1e-9


def test_against_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 16)
    rng = np.random.default_rng(2)
    data = [(i, (rng.normal(size=6) * [1, 3, 0.5, 2, 0.1, 1]).tolist()) for i in range(80)]
    data += [(200, None), (201, [None] * 6), (202, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (203, [float("inf")] * 6), (204, [1.0, 2.0]), (205, []), (None, data[0][1]), (3, data[4][1]), (3, data[4][1])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in data], ROWS).repartition(7)
    model = whitening.fit(frame)
    found = whitening.whiten(frame, model)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), expected(data))


def test_low_rank_and_empty(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 1, 2) for i, v in rows], ROWS)
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        frame = make(rows)
        assert whitening.whiten(frame, whitening.fit(frame)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)] + [(9, [4.0, 8.0])]
    check(whitening.whiten(make(line), whitening.fit(make(line))).collect(), expected(line))


def test_large_entries(spark):
    """Sums and deviations stay exact where doubles and longs do not hold them."""
    huge = spark.createDataFrame([(i, v) for i, v in enumerate([[1e300, 0.0], [-1e300, 1.0], [2.0 ** 50 + 256, 2.0], [3.0, 5.0]])], "vec_id long, embedding array<double>")
    model = whitening.fit(huge)
    assert model.n == 4 and model.sums[0] == (1 << 63) - 1 - (1 << 63) + 256 * ((1 << 50) + 256) + 768 and model.sums[1] == 256 * 8
    found = {(r.vec_id, r.component): r for r in whitening.whiten(huge, model).collect()}
    assert found[0, 1].deviation is None and found[3, 1].n == 4 and found[0, 1].identity_error < 1e-9
    fine = spark.createDataFrame([(0, [float(1 << 20)]), (1, [0.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(fine, whitening.fit(fine)).collect()} == {(1 << 28) ** 2}


def test_singular_values_and_vectors():
    rng = np.random.default_rng(0)
    turn = lambda n: np.linalg.qr(rng.normal(size=(n, n)))[0]
    squares = [np.linalg.qr(rng.normal(size=(4 * n, n)), mode="r") for n in (1, 2, 3, 7, 40, 64)]
    squares += [np.diag([3.0, 3, 3, 3, 1]), np.eye(6), turn(20) @ np.diag([5.0] * 5 + [4.999999] + [1e-3] * 14) @ turn(20), turn(20) @ np.diag(np.logspace(5, -12, 20)) @ turn(20),
                np.outer(rng.normal(size=8), rng.normal(size=8)), turn(9) @ np.diag([4.0, 4, 3, 3, 2, 2, 1, 1, 0]) @ turn(9)]
    for matrix in squares:
        want = np.linalg.svd(matrix, compute_uv=False)
        a, b, _ = singular.bidiagonal(matrix)
        assert np.allclose(singular.dqds(a, b), want, rtol=1e-12, atol=1e-14 * want[0])
        values, vectors = singular.top_directions(matrix, 4)
        assert len(values) == min(4, int((want > len(matrix) * singular.EPS * want[0]).sum()))
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-11
        assert np.abs(matrix.T @ (matrix @ vectors.T) - vectors.T * values ** 2).max() < 1e-13 * want[0] ** 2
    assert len(singular.top_directions(np.zeros((3, 3)), 4)[0]) == 0


def test_small_values_to_relative_accuracy():
    """dqds keeps the digits of values far below the largest one."""
    a, b = np.logspace(0, -14, 30), np.logspace(0, -14, 30)[1:] * 0.3
    exact = np.sort([float(x) for x in _precise(a, b)])[::-1]
    assert np.allclose(singular.dqds(a, b), exact, rtol=1e-11)


def _precise(a, b):
    """Bisection with Sturm counts in exact fractions would be slow; in 60-digit decimals it is not."""
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    d = [Decimal(float(x)) ** 2 for x in a]
    low = [Decimal(float(y)) / Decimal(float(x)) for x, y in zip(a, b)]

    def below(value):
        s, count = -value, 0
        for i in range(len(d)):
            pivot = s + d[i]
            count += pivot < 0
            if i < len(d) - 1:
                s = d[i] * low[i] * low[i] / (pivot or Decimal("1e-50")) * s - value
        return count

    for k in range(len(d)):
        lo, hi = Decimal(0), Decimal(4)
        lo = Decimal("1e-40")
        for _ in range(150):
            mid = (lo * hi).sqrt()
            lo, hi = (lo, mid) if below(mid) > k else (mid, hi)
        yield lo.sqrt()


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check(QUERIES["op13_whitening"](spark, FOLDER).collect(), expected([(r.vec_id, r.embedding) for r in rows]))
