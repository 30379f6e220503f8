"""Whitened embeddings: covariance summed on Spark, leading components by Householder, Sturm counts and inverse iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches

COMPONENTS = 8
# An entry c becomes floor(SCALE c) + SHIFT, so that sums over all rows are exact.
SCALE, SHIFT = 1024.0, 100_000
# Entries of this size and more are no coordinates: their fixed-point sums would not fit.
_TOO_LARGE = float(1 << 30)
_EPS = np.finfo(float).eps
_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


class Components(NamedTuple):
    """``n`` rows with sums ``sums``; unit eigenvectors ``vectors`` (columns) for falling ``values``; ``trace`` of the covariance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def fixed_point(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of length ``dim`` with finite entries alone, and their entries in fixed point."""
    if pa.types.is_null(column.type.value_type) or not len(column):
        return np.empty(0, np.int64), np.empty((0, dim), np.int64)
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(kept)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(kept), dim)
    with np.errstate(invalid="ignore"):
        fine = (np.abs(flat) < _TOO_LARGE).all(axis=1)  # a null entry reads as NaN
    return kept[fine], np.floor(SCALE * flat[fine]).astype(np.int64) + SHIFT


def whiten(rows: DataFrame, *, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row per vector and leading component: the vector's whitened coordinate, and figures of the fit.

    Columns: ``vec_id``, ``component`` (from 1), ``n`` (vectors of the fit), ``deviation`` (sum over
    dimensions of (n x - S)^2, exact; null beyond 64 bits), ``whitened``, ``explained`` (share of
    the trace), ``identity_error`` (largest entry of whitened's covariance less the identity,
    measured over all rows, the same everywhere).

    Null vectors, vectors with null, non-finite or 2^30 and larger entries, and vectors whose
    length is not the most frequent one (of equals the longest) are left out of fit and result. A
    component without variance cannot be whitened and has no rows, so vectors that are all alike
    give none; null keys and repeated rows are rows like others; other columns are ignored; no
    rows give no rows. The driver and each task hold matrices of dimension squared, no rows.
    """
    vectors = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("x"))
    fit = fit_components(vectors, components)
    if fit is None or not len(fit.values):
        return rows.sparkSession.createDataFrame([], _OUT)
    error = _identity_error(vectors, fit)
    return map_batches(vectors, _projected(fit, error), _OUT)


def fit_components(vectors: DataFrame, components: int = COMPONENTS) -> Components | None:
    """Leading components of the covariance of ``x``; None without usable vectors."""
    spark_sums = _summed(vectors, _count_and_sum)  # a row per length that occurs
    lengths = {int(k): v for k, v in spark_sums.items() if v[0] > 0}
    if not lengths:
        return None
    dim = max(lengths, key=lambda d: (lengths[d][0], d))
    n, sums = int(lengths[dim][0]), lengths[dim][1:]
    if not dim:
        return None
    mean = sums / n
    parts = _summed(vectors, _centred_products(dim, mean), "double")
    covariance = np.stack([parts[i] for i in range(dim)]) / n
    covariance = (covariance + covariance.T) / 2
    values, found = leading(covariance, min(components, dim))
    trace = float(np.trace(covariance))
    real = values > dim * _EPS * trace
    return Components(n, sums, found[:, real], values[real], trace)


# ---- sums over all rows -------------------------------------------------------------------------


def _summed(rows: DataFrame, partial: Callable, kind: str = "bigint") -> dict[int, np.ndarray]:
    """Arrays by key that ``partial`` makes of each task's rows, summed up over tasks.

    Arrays of one key meet in one task, which adds them as they come; the driver gets one array
    per key. Keys are the lengths of vectors, or rows of a matrix.
    """
    schema = f"key bigint, values array<{kind}>"
    parts = map_batches(rows, partial, schema).repartition("key")
    return {r["key"]: np.array(r["values"]) for r in map_batches(parts, _added, schema).collect()}


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field(1).type
        for key, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            row = values.values.to_numpy(zero_copy_only=False)
            sums[key] = sums[key] + row if key in sums else row.copy()
    if sums:
        yield _keyed(sums, kind.value_type)


def _keyed(sums: dict[int, np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([list(v) for v in sums.values()], pa.list_(kind))], ["key", "values"])


def _count_and_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length of vector the number of usable ones and their exact sums."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column(1)
        for dim in {d for d in column.value_lengths().to_pylist() if d is not None}:
            _, x = fixed_point(column, dim)
            row = np.concatenate([[len(x)], x.sum(axis=0)])
            sums[dim] = sums[dim] + row if dim in sums else row
    if sums:
        yield _keyed(sums, pa.int64())


def _centred_products(dim: int, mean: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            centred = fixed_point(batch.column(1), dim)[1] - mean
            total += centred.T @ centred
        yield _keyed(dict(enumerate(total)), pa.float64())

    return run


def _identity_error(vectors: DataFrame, fit: Components) -> float:
    k, dim = len(fit.values), len(fit.sums)
    mean, basis = fit.sums / fit.n, fit.vectors / np.sqrt(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = (fixed_point(batch.column(1), dim)[1] - mean) @ basis
            total[:k] += z.T @ z
            total[k] += z.sum(axis=0)
        yield _keyed(dict(enumerate(total)), pa.float64())

    parts = _summed(vectors, run, "double")
    centre = parts[k] / fit.n
    return float(np.abs(np.stack([parts[i] for i in range(k)]) / fit.n - np.outer(centre, centre) - np.eye(k)).max())


def _projected(fit: Components, error: float) -> Callable:
    """Rows of all components for each vector; the fit goes out with the function."""
    k, dim = len(fit.values), len(fit.sums)
    mean, basis = fit.sums / fit.n, fit.vectors / np.sqrt(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = fixed_point(batch.column(1), dim)
            z = (x - mean) @ basis
            apart = deviations(fit.n, x, fit.sums)
            columns = [
                batch.column(0).take(pa.array(np.repeat(kept, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept))),
                pa.array(np.full(len(kept) * k, fit.n)), pa.array([d for d in apart for _ in range(k)], pa.int64()), pa.array(z.reshape(-1)),
                pa.array(np.tile(fit.values / fit.trace, len(kept))), pa.array(np.full(len(kept) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _OUT.split(", ")])

    return run


def deviations(n: int, x: np.ndarray, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null where 64 bits do not hold it."""
    if not len(x):
        return []
    most = max(int(abs(n * int(v) - int(s))) for v, s in [*zip(x.min(axis=0), sums, strict=True), *zip(x.max(axis=0), sums, strict=True)])
    if most * most * len(sums) < 1 << 63 and n * int(np.abs(x).max()) < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


# ---- leading eigenvectors -----------------------------------------------------------------------


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    The entry of largest size in a vector is positive.
    """
    size = np.abs(matrix).max()
    if not size:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, beside, mirrors = tridiagonal(matrix / size)
    values = bisected(diagonal, beside, k)
    vectors = inverse_iterated(diagonal, beside, values)
    for start, mirror in reversed(mirrors):
        vectors[start:] -= np.outer(2 * mirror, mirror @ vectors[start:])
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    return values * size, vectors * np.where(vectors[largest, np.arange(k)] < 0, -1.0, 1.0)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the mirrors (first row and unit normal) that Householder's method applies."""
    a = matrix.astype(float, copy=True)
    mirrors = []
    for j in range(len(a) - 2):
        normal = a[j + 1 :, j].copy()
        length = np.linalg.norm(normal)
        if np.linalg.norm(normal[1:]) == 0:
            continue
        normal[0] += np.copysign(length, normal[0])
        normal /= np.linalg.norm(normal)
        mirrors.append((j + 1, normal))
        a[j + 1 :, j:] -= np.outer(2 * normal, normal @ a[j + 1 :, j:])
        a[j:, j + 1 :] -= np.outer(a[j:, j + 1 :] @ normal, 2 * normal)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def larger(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each of some numbers: positive terms of Sturm's sequence."""
    least = _EPS * max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0)) ** 2 + np.finfo(float).tiny
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (beside[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q > 0
    return count


def bisected(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each halved in until the numbers between run out."""
    reach = np.concatenate([np.abs(beside), [0]]) + np.concatenate([[0], np.abs(beside)])
    slack = 4 * _EPS * max(np.abs(diagonal).max() + reach.max(), np.finfo(float).tiny)
    low, high = np.full(k, (diagonal - reach).min() - slack), np.full(k, (diagonal + reach).max() + slack)
    rank = np.arange(k)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= _EPS * np.maximum(np.abs(low), np.abs(high)))).all():
            return middle
        above = larger(diagonal, beside, middle) > rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def inverse_iterated(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix; those of values in a cluster are made orthogonal in every step."""
    size = max(np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0.0), np.finfo(float).tiny)
    rng = np.random.default_rng(12)
    out = np.empty((len(diagonal), len(values)))
    cluster = 0
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            cluster = j
        shift = min(value, shift - 4 * _EPS * size) if j > cluster else value
        solve = _factored(diagonal - shift, beside, _EPS * size)
        vector = rng.standard_normal(len(diagonal))
        for _ in range(5):
            vector = solve(vector / np.linalg.norm(vector))
            for _ in range(2):
                vector -= out[:, cluster:j] @ (out[:, cluster:j].T @ vector)
        out[:, j] = vector / np.linalg.norm(vector)
    return out


def _factored(diagonal: np.ndarray, beside: np.ndarray, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """A solver for a symmetric tridiagonal matrix, by elimination with row swaps; a pivot is never less than ``least``."""
    n = len(diagonal)
    d, up, up2 = diagonal.tolist(), [*beside.tolist(), 0.0], [0.0] * n
    low = beside.tolist()
    factor, swapped = [0.0] * n, [False] * n
    for i in range(n - 1):
        if abs(low[i]) > max(abs(d[i]), least):
            swapped[i] = True
            d[i], up[i], up2[i], row = low[i], d[i + 1], up[i + 1], (d[i], up[i])
            factor[i] = row[0] / d[i]
            d[i + 1], up[i + 1] = row[1] - factor[i] * up[i], -factor[i] * up2[i]
        else:
            d[i] = d[i] if abs(d[i]) >= least else least
            factor[i] = low[i] / d[i]
            d[i + 1] -= factor[i] * up[i]
    d[-1] = d[-1] if abs(d[-1]) >= least else least

    def solve(right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i in range(n - 1):
            if swapped[i]:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factor[i] * b[i]
        for i in range(n - 1, -1, -1):
            rest = b[i] - (up[i] * b[i + 1] if i + 1 < n else 0.0) - (up2[i] * b[i + 2] if i + 2 < n else 0.0)
            b[i] = rest / d[i]
        return np.array(b)

    return solve
