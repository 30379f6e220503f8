"""Whitening against exact sums and a library's eigenvectors; the eigensolver on hard matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm.queries import op12_whitening
from tidelake.llm.whitening import deviations, leading, tridiagonal, whiten

SCHEMA = "vec_id bigint, embedding array<float>, n bigint, component string"


def plain(vectors, k=8):
    """By id: deviation and whitened coordinates up to their signs; and the shares."""
    x = {i: [int(np.floor(1024 * float(c))) + 100_000 for c in v] for i, v in vectors.items()}
    n, sums = len(x), [sum(col) for col in zip(*x.values(), strict=True)]
    fit = np.array(list(x.values()), float) - np.array(sums) / n
    cov = fit.T @ fit / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    z = fit @ vecs / np.sqrt(values)
    apart = {i: sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for i, row in x.items()}
    return apart, dict(zip(x, z, strict=True)), values / np.trace(cov)


def check(got, vectors, k=8):
    apart, z, shares = plain(vectors, k)
    assert len(got) == len(vectors) * k and {r.vec_id for r in got} == set(vectors)
    signs = {r.component: np.sign(r.whitened * z[r.vec_id][r.component - 1]) for r in got if abs(r.whitened) > 0.1}
    for r in got:
        assert r.n == len(vectors) and r.deviation == apart[r.vec_id]
        assert abs(r.whitened - signs[r.component] * z[r.vec_id][r.component - 1]) < 1e-8
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_query_equals_a_library(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(op12_whitening(spark, small).collect(), {i: v for i, v in table})


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = {i: np.float32(v).tolist() for i, v in enumerate(rng.standard_normal((60, 5)) * [9, 4, 2, 1, 0.5])}
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, 2.0, float("inf"), 0.0, 0.0], [1.0, 2.0], [1e38] * 5]
    rows = [(i, v, 1, "x") for i, v in good.items()] + [(100 + i, v, 1, "x") for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(whiten(frame).collect(), good, 5)
    assert whiten(frame.where("vec_id > 99 AND vec_id <> 105")).collect() == []
    assert whiten(frame.limit(0)).collect() == []
    assert whiten(frame.where("vec_id = 3")).collect() == []  # one vector has no variance
    twice = frame.where("vec_id < 60").withColumn("vec_id", F.lit(None).cast("bigint"))
    assert whiten(twice.union(twice)).count() == 600


def matrices():
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "random", (lambda a: a @ a.T)(rng.standard_normal((40, 60)))
    yield "cluster", q @ np.diag([5, 5, 5, 5 - 1e-9, 5 - 1e-12, *np.linspace(2, 0, 35)]) @ q.T
    yield "identity", np.eye(30)
    yield "blocks", np.kron(np.eye(10), np.array([[2.0, 1, 0], [1, 2, 1], [0, 1, 2]]))
    yield "low rank", (lambda a: a @ a.T)(rng.standard_normal((30, 3)))
    yield "graded", np.diag(10.0 ** -np.arange(20)) + 1e-9
    yield "tiny", 1e-200 * q @ np.diag(np.arange(40.0)) @ q.T
    yield "one", np.array([[3.0]])
    yield "zero", np.zeros((9, 9))


@pytest.mark.parametrize("name,a", list(matrices()))
def test_leading_components(name, a):
    a = (a + a.T) / 2
    k = min(8, len(a))
    values, vectors = leading(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    size = max(np.abs(want).max(), 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size


def test_tridiagonal():
    a = np.random.default_rng(1).standard_normal((25, 25))
    d, e, mirrors = tridiagonal(a + a.T)
    assert len(mirrors) == 23
    assert np.allclose(np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1)), np.linalg.eigvalsh(a + a.T))


def test_deviations_are_exact():
    x = np.array([[100_000, 1 << 30], [100_001, -5]])
    sums = x.sum(axis=0)
    assert deviations(2, x, sums) == [sum((2 * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert deviations(10**12, x, x.sum(axis=0)) == [None, None]
