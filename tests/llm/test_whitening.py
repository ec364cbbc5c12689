"""Whitening against a dense eigen solver."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokeline.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def _frame(spark, rows, kind="float"):
    full = [(i, v, "c", 1.0) for i, v in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, component string, n double")


def _usable(rows):
    kept = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    return [i for i, _ in kept], np.array([np.floor(64 * np.array(v, float)) + 1_000_000 for _, v in kept])


def _check(found, rows, most=32):
    ids, x = _usable(rows)
    n = len(x)
    whole = [[int(e) for e in v] for v in x]
    sums = [sum(c) for c in zip(*whole)]
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == n * k
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    white = centred @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = {}
    for i, v in zip(ids, whole):
        deviation.setdefault(i, []).append(sum((n * e - s) ** 2 for e, s in zip(v, sums)))
    for i, components in by_id.items():
        assert sorted(components) == list(range(1, k + 1))
        for rs in components.values():
            assert sorted(int(r.deviation) for r in rs) == sorted(deviation[i])
    first = found[0]
    assert {r.n for r in found} == {n} and first.identity_error <= 1e-9
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    if len(set(ids)) == n:  # the same columns, but for signs, where eigenvalues stand apart
        mine = np.array([[by_id[i][c][0].whitened for c in range(1, k + 1)] for i in ids])
        apart = np.min(np.abs(values[:k, None] - values[None]) + np.eye(k, len(values)) * 1e9, axis=1) > 1e-3 * values[0]
        for c in np.flatnonzero(apart):
            sign = np.sign(mine[:, c] @ white[:, c])
            assert np.allclose(mine[:, c] * sign, white[:, c], atol=1e-7)
        assert np.allclose(np.cov(mine.T, bias=True), np.eye(k), atol=1e-9)


def test_op11_over_its_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _check(queries.op11_whitening(spark, SF).collect(), rows)


def test_unusable_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [math.nan] * 6)]
    rows += [(104, [math.inf] + [0.0] * 5), (None, [0.5] * 6), (7, rows[7][1]), (7, rows[7][1])]
    _check(whitening.whitened(_frame(spark, rows)).collect(), rows)


def test_fewer_components_and_equal_eigenvalues(spark):
    corners = [(i, [float((i >> b) & 1) for b in range(4)] + [2.0]) for i in range(16)]  # one eigenvalue, four times
    _check(whitening.whitened(_frame(spark, corners), 3).collect(), corners, 3)
    _check(whitening.whitened(_frame(spark, corners)).collect(), corners)


def test_no_vectors_and_equal_vectors(spark):
    assert whitening.whitened(_frame(spark, [])).count() == 0
    assert whitening.whitened(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=3) * 10.0**9).tolist()) for i in range(20)]
    _check(whitening.whitened(_frame(spark, rows, "double")).collect(), rows)


def test_what_has_no_place_is_refused(spark):
    for rows in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, [1e300]), (2, [0.0])]):
        with pytest.raises(Exception, match="several lengths|no exact place"):
            whitening.whitened(_frame(spark, rows, "double")).collect()


@pytest.mark.parametrize("gaps", [1.0, 1e-6, 1e-9, 1e-13, 0.0])
def test_slicing_numbers_every_eigenvalue(gaps):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    true = np.sort(np.concatenate([5 + gaps * np.arange(5), 3 + gaps * np.arange(3), rng.uniform(0, 1, 32)]))[::-1]
    v = q @ np.diag(true) @ q.T
    values, vectors = whitening.leading(v, 20)
    assert np.allclose(values, true[:20], atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(20), atol=1e-9)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-10


@pytest.mark.parametrize("size", [1, 2, 5, 30])
def test_factors_and_counts(size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, size))
    for v in (a + a.T, np.eye(size)[::-1].copy(), np.zeros((size, size))):
        order, lower, d, _ = whitening.factored(v)
        assert np.allclose(lower @ d @ lower.T, v[np.ix_(order, order)], atol=1e-10)
        for shift in (-0.37, 0.21, 1.5):
            assert whitening.above(v, shift) == int((np.linalg.eigvalsh(v) > shift).sum())


def test_one_row_spread_over_many_tasks(spark):
    rows = [(i, [float(i % 7), float(i % 3), 1.0 / (i + 1)]) for i in range(200)]
    few = whitening.whitened(_frame(spark, rows).coalesce(1)).orderBy("vec_id", "component").collect()
    many = whitening.whitened(_frame(spark, rows).repartition(40, F.rand(1))).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.deviation, r.whitened, r.explained) for r in few] == [
        (r.vec_id, r.deviation, r.whitened, r.explained) for r in many
    ]
