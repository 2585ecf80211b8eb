"""The bidiagonal solver against a library's singular values, and whitening against a plain computation."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from emberline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, c string, r string"


def matrices():
    draw = np.random.default_rng(0)
    for i in range(120):
        n, m = int(draw.integers(1, 50)), int(draw.integers(1, 120))
        a = draw.standard_normal((m, n))
        if i % 6 == 1:
            a *= 10.0 ** draw.uniform(-8, 8, n)
        elif i % 6 == 2:
            a[:, n // 2:] = a[:, :1]
        elif i % 6 == 3:
            a = np.round(a)
        elif i % 6 == 4:
            a = np.linalg.qr(draw.standard_normal((max(m, n), n)))[0]
        elif i % 6 == 5:
            a = np.zeros((m, n))
            k = min(m, n)
            a[:k, :k] = np.diag(np.repeat([3.0, 2.0, 1.0], 20)[:k])
        yield a


def test_the_solver():
    for a in matrices():
        n = a.shape[1]
        r = whitening.triangle(a)
        want = np.zeros(n)
        found = np.linalg.svd(a, compute_uv=False)
        want[:len(found)] = found
        d, f, right = whitening.bidiagonal(r)
        assert np.abs(right.T @ right - np.eye(n)).max() < 1e-13 * n
        assert np.abs(whitening.dqds(d, f) - want).max() <= 1e-13 * n * want[0]
        values, vectors = whitening.principal(r, 4)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11
        assert np.abs(a.T @ (a @ vectors) - vectors * values**2).max() < 1e-13 * max(a.shape) * want[0] ** 2


def test_small_values_keep_their_relative_accuracy():
    d, f = np.array([1.0, 1e-6, 1e-12]), np.array([1e-3, 1e-9])
    product = math.prod(d.tolist())
    assert math.prod(whitening.dqds(d, f).tolist()) == pytest.approx(product, rel=1e-13)


def test_no_variance():
    assert len(whitening.principal(np.zeros((5, 5)), 4)[0]) == 0
    assert len(whitening.principal(np.ones((1, 1)), 4)[0]) == 1


def plain(rows, components=4):
    """{(id, component): (n, deviation, whitened without its sign, explained)}"""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v) and len(v) == 6]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = [[Fraction(n * c - s, n) for c, s in zip(x, sums, strict=True)] for x in fit]
    cov = np.array([[float(sum(x[i] * x[j] for x in centred) / n) for j in range(6)] for i in range(6)])
    e, v = np.linalg.eigh(cov)
    by = np.argsort(-e)[:components]
    out = []
    for i, x in kept:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k, j in enumerate(by):
            w = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)]) @ v[:, j] / math.sqrt(e[j])
            out.append((i, k + 1, n, dev, abs(w), e[j] / np.trace(cov)))
    return out


def test_whitening(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, j + 1) for j in range(6)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]  # copies count once
    rows += [(100, rows[0][1]), (None, rows[1][1]), (200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6),
             (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0]), (206, [-0.001] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x", "c", "r") for i, v in rows], SCHEMA).repartition(7)
    found = whitening.whiten(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    want = sorted(plain(rows), key=key)
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in found), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and 0 <= found[0]["identity_error"] < 1e-10


def test_signs_are_the_same_for_all_rows(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 3), draw.gauss(0, 2)], 1, "x", "c", "r") for i in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).where("component = 1").collect()
    x = {i: np.floor(256 * np.float32(v).astype(float)) for i, v, *_ in rows}
    mean = np.mean(list(x.values()), axis=0)
    design = np.array([x[r["vec_id"]] - mean for r in found])
    fitted, residual, *_ = np.linalg.lstsq(design, np.array([r["whitened"] for r in found]), rcond=None)
    assert residual.max(initial=0) < 1e-12


def test_large_entries_stay_exact(spark):
    big = [(i, [float(1 << 30) * (1 + i % 3), float(i)], 1, "x", "c", "r") for i in range(30)]
    found = {(r["vec_id"], r["component"]): r["deviation"] for r in whitening.whiten(spark.createDataFrame(big, SCHEMA)).collect()}
    x = [(256 * (1 << 30) * (1 + i % 3), 256 * i) for i in range(30)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((30 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    assert all(found[i, 1] == (w if w < 1 << 63 else None) for i, w in enumerate(want))


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, "x", "c", "r") for i, v in enumerate(vectors)], SCHEMA)
    assert whitening.whiten(df).collect() == []


def test_fewer_dimensions_than_components(spark):
    df = spark.createDataFrame([(i, [float(i * i)], 1, "x", "c", "r") for i in range(9)], SCHEMA)
    found = whitening.whiten(df).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9 and found[0]["explained"] == pytest.approx(1)
