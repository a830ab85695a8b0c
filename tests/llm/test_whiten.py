"""Spectrum slicing against a dense solver, and the whole operator against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from scrimlens.llm import queries
from scrimlens.llm.whiten import Spectrum, Whitening, above, whitening

SF_DIR = "/root/testdata/sf0.001"
ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    *[T.StructField(c, T.StringType()) for c in ("id", "x", "v", "n", "m", "d", "whitened")]])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *["q"] * 7) for i, v in rows], ROWS)


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for t in range(150):
        a = rng.normal(size=(d := int(rng.integers(1, 30)), d))
        a = a + a.T
        if t % 3 == 0:
            a = np.round(a)
        if t % 5 == 0:
            np.fill_diagonal(a, 0)
        w = np.linalg.eigvalsh(a)
        for shift in rng.normal(size=4) * 3:
            assert above(a, shift) == (w > shift).sum()


@pytest.mark.parametrize("kind", ["random", "dependent", "equal", "clusters", "rotated", "rank"])
def test_leading_vectors(kind):
    rng = np.random.default_rng(7)
    for _ in range(12):
        d, n = int(rng.integers(2, 40)), int(rng.integers(2, 80))
        x = np.floor(rng.normal(size=(3 if kind == "rank" else n, d)) * rng.choice([1, 8, 100], size=d))
        if kind == "dependent":
            x = x[:, rng.integers(0, d, size=d)]
        v = np.cov(x.T, bias=True).reshape(d, d)
        steps = np.r_[np.repeat(7.0, d // 2), np.arange(d - d // 2) + 1.0]
        if kind == "equal":
            v = 3.0 * np.eye(d)
        if kind == "clusters":
            v = np.diag(steps)
        if kind == "rotated":
            q = np.linalg.qr(rng.normal(size=(d, d)))[0]
            v = q @ np.diag(steps) @ q.T
            v = (v + v.T) / 2
        values, found = Spectrum(v).leading(16)
        want = np.linalg.eigvalsh(v)[::-1]
        norm = np.abs(v).sum(axis=1).max()
        assert len(values) == min(16, d, (want > 16 * d * 2.0**-52 * norm).sum())
        assert np.allclose(values, want[: len(values)], rtol=0, atol=1e-13 * norm)
        assert np.allclose(found @ found.T, np.eye(len(values)), atol=1e-12)
        assert np.allclose(found @ v, values[:, None] * found, rtol=0, atol=1e-12 * norm)


def brute(rows, components=16):
    """id, deviation, whitened of every usable row, with n and the shares."""
    usable = [(i, np.array([math.floor(64 * c) + 1_000_000 for c in v])) for i, v in rows]
    fit = np.unique(np.array([x for _, x in usable]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - 1_000_000) - (sums - n * 1_000_000) / n
    v = centred.T @ centred / n
    w, u = np.linalg.eigh(v)
    w, u = w[::-1][:components], u[:, ::-1][:, :components]
    out = []
    for i, x in usable:
        y = (x - 1_000_000) - (sums - n * 1_000_000) / n
        out.append((i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)), y @ u / np.sqrt(w)))
    return n, w / np.trace(v), out


def test_query_equals_dense_solver(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    n, shares, want = brute([(r.vec_id, r.embedding) for r in table])
    got = queries.op12_whitening(spark, SF_DIR).collect()
    assert len(got) == 16 * len(table)
    rows = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-10 and abs(r.explained - shares[r.component - 1]) < 1e-12
        rows.setdefault(r.vec_id, {})[r.component] = r
    signs = None
    for i, deviation, white in want:
        mine = np.array([rows[i][k].whitened for k in range(1, 17)])
        assert rows[i][1].deviation == deviation
        signs = np.sign(mine * white) if signs is None else signs
        assert np.allclose(mine, signs * white, atol=1e-9)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.25, 3.0, 2.0]), (2, [0.25, 3.0, 2.0]), (None, [1.5, 0.0, 0.0]), (4, [2.0, 2.0, 9.0])]
    bad = [(5, None), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 2.0]), (8, [1.0, -inf, 2.0]), (9, []), (10, [1.0, 2.0]), (11, [1e300, 0.0, 0.0])]
    n, shares, want = brute(good)
    got = whitening(vectors(spark, good + bad)).collect()
    assert sorted((str(r.vec_id), int(r.deviation)) for r in got) == sorted((str(i), d) for i, d, _ in want)
    assert {r.n for r in got} == {n} == {4} and all(len(r.whitened) == 3 for r in got)
    assert np.allclose(got[0].explained, shares)
    assert whitening(vectors(spark, [])).count() == whitening(vectors(spark, bad[:1])).count() == 0


def test_without_variance(spark):
    got = whitening(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, [None, None], [None, None], None)] * 2
    line = whitening(vectors(spark, [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])])).collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None and r.explained == [1.0, 0.0] for r in line)


def test_deviations_beyond_long_are_exact():
    x = np.array([[2**40, 5], [0, 7]])
    model = Whitening(10**9, [3, 10**10], np.array([0, 10]), np.zeros(0), np.zeros((0, 2)), 0.0)
    assert list(model.deviations(x)) == [(10**9 * int(a) - 3) ** 2 + (10**9 * int(b) - 10**10) ** 2 for a, b in x]
