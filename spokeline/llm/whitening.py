"""Embedding whitening on the leading components, found by slicing the covariance's spectrum.

1. **Sums** of the vectors, exact integers, are added up by dimension.
2. **Covariance**: vectors are centred by the nearest integers to their means, multiplied, and summed as
   exact integers; what the integers miss of the means is taken off exactly. One matrix of
   dimensions squared reaches the driver, whatever the number of vectors.
3. **Slicing**: the pivots of an LDL' factorisation of ``V - s I`` have as many positive signs as V
   has eigenvalues above s (Sylvester's law). Intervals are halved until each holds one
   eigenvalue, or a cluster too narrow to tell apart. In an interval with one, inverse iteration
   gives a first vector and Rayleigh quotient iteration, which converges cubically, the rest; a quotient
   that leaves its interval halves it again. Counts on both sides of the result
   certify its number. A cluster's vectors come from a block of inverse iterations and the same
   slicing of the covariance within their span.
4. **Whitening**: every task multiplies its centred vectors with the components over the
   roots of their eigenvalues, and the covariance of what comes out is measured over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeline.llm.shared_files import ship

SCALE, SHIFT = 64, 1_000_000
EPS = float(np.finfo(float).eps)
# Eigenvalues nearer than this share of the largest are treated as a cluster.
CLUSTER = 1e-7
# Integers up to here are added and multiplied without error in doubles.
EXACT = 2**53


# -- vectors ---------------------------------------------------------------------


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite numbers, and those vectors as whole numbers without ``SHIFT``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.list_flatten(column)
    values = entries.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    rows = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.zeros(len(sizes), bool)
    bad[rows[~np.isfinite(values)]] = True
    used = np.flatnonzero(~bad & (sizes > 0))
    if not len(used):
        return used, np.empty((0, 0), np.int64)
    if len(set(sizes[used].tolist())) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(set(sizes[used].tolist()))[:5]}")
    kept = np.floor(SCALE * values[~bad[rows]])
    if np.abs(kept).max() >= EXACT:
        raise ValueError(f"entries of {EXACT // SCALE} or more have no exact place")
    return used, kept.astype(np.int64).reshape(len(used), -1)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` as exact integers: in doubles while sums stay below ``EXACT``, else as Python integers."""
    largest = int(np.abs(y).max(initial=0))
    step = EXACT // max(1, largest * largest)
    if not step:
        whole = y.astype(object)
        return whole.T @ whole
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _exact_sums(x: np.ndarray) -> np.ndarray:
    small = int(np.abs(x).max()) * len(x) < 2**63
    return x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)


WHOLE = T.DecimalType(38, 0)


def _added(vectors: DataFrame, task) -> list[tuple]:
    """Whole numbers of all tasks added up by place: (place, n, sum), as many as a task sends."""
    schema = T.StructType(
        [T.StructField("place", T.LongType()), T.StructField("n", T.LongType()), T.StructField("value", WHOLE)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            used, x = _vectors(batch.column(0))
            if len(used):
                found = task(x).ravel()
                if total is not None and len(found) != len(total):
                    raise ValueError("vectors of several lengths")
                n, total = n + len(used), found if total is None else total + found
        if n:
            places = pa.array(np.arange(len(total)))
            yield pa.RecordBatch.from_arrays(
                [places, pa.repeat(pa.scalar(n, pa.int64()), len(total)), pa.array(total.tolist(), pa.decimal128(38, 0))],
                names=["place", "n", "value"],
            )

    sums = vectors.mapInArrow(run, schema).groupBy("place").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    return [(r.place, r.n, int(r.value)) for r in sums.orderBy("place").collect()]


def fitted(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums by dimension, and their covariance.

    Sums are of entries without ``SHIFT``. All products are exact; the covariance is rounded once.
    """
    sums = _added(vectors, _exact_sums)
    if not sums:
        return 0, [], np.empty((0, 0))
    if len({n for _, n, _ in sums}) > 1:
        raise ValueError("vectors of several lengths")
    n, total = sums[0][1], [s for _, _, s in sums]
    centre = np.array([round(Fraction(s, n)) for s in total], np.int64)
    products = _added(vectors, lambda x: _exact_products(x - centre))
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    dims = len(total)
    covariance = np.empty((dims, dims))
    for place, _, value in products:
        i, j = divmod(place, dims)
        covariance[i, j] = Fraction(n * value - rest[i] * rest[j], n * n)
    return n, total, covariance


# -- spectrum ----------------------------------------------------------------------


def factored(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """``P A P' = L D L'`` of a symmetric matrix, with diagonal pivoting by blocks of one or two rows.

    Returns the order of rows, L, D and the blocks as (first row, size).
    """
    a = a.copy()
    n = len(a)
    order, lower, blocks, k = np.arange(n), np.eye(n), [], 0
    ratio = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            order[[i, j]] = order[[j, i]]
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            lower[[i, j], :k] = lower[[j, i], :k]

    while k < n:
        rest = a[k:, k:]
        on = np.abs(np.diag(rest))
        best = int(on.argmax())
        off = np.abs(np.tril(rest, -1))
        size = 1
        if k < n - 1 and off.max() > 0 and on[best] < ratio * off.max():
            i, j = np.unravel_index(off.argmax(), off.shape)  # i > j
            swap(k, k + int(j))
            swap(k + 1, k + int(i))
            size = 2
        else:
            swap(k, k + best)
        pivot = a[k : k + size, k : k + size]
        if size == 2 or pivot[0, 0] != 0:
            column = a[k + size :, k : k + size]
            factor = np.linalg.solve(pivot, column.T).T
            a[k + size :, k + size :] -= factor @ column.T
            lower[k + size :, k : k + size] = factor
        blocks.append((k, size))
        k += size
    d = np.zeros((n, n))
    for at, size in blocks:
        d[at : at + size, at : at + size] = a[at : at + size, at : at + size]
    return order, lower, d, blocks


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: positive signs in D, one of each in a block of two."""
    _, _, d, blocks = factored(v - shift * np.eye(len(v)))
    return sum(1 if size == 2 else int(d[at, at] > 0) for at, size in blocks)


def _solve(factors, b: np.ndarray, least: float) -> np.ndarray:
    """Solution by the factors; pivots of nothing count as ``least``, which inverse iteration wants."""
    order, lower, d, blocks = factors
    y = b[order].astype(float)
    for at, size in blocks:
        y[at + size :] -= lower[at + size :, at : at + size] @ y[at : at + size]
    for at, size in blocks:
        pivot = d[at : at + size, at : at + size]
        if size == 1:
            y[at] /= pivot[0, 0] if abs(pivot[0, 0]) > least else least
        else:
            y[at : at + size] = np.linalg.solve(pivot, y[at : at + size])
    for at, size in reversed(blocks):
        y[at : at + size] -= lower[at + size :, at : at + size].T @ y[at + size :]
    x = np.empty_like(y)
    x[order] = y
    return x


def _start(n: int, k: int) -> np.ndarray:
    """Fixed vectors to begin with, with parts in every direction."""
    return np.cos(np.outer(np.arange(1, n + 1) ** 2, np.arange(1, k + 1)) * 0.7)


def _refined(v: np.ndarray, low: float, high: float, size: float) -> tuple[float, np.ndarray] | None:
    """The eigenvalue in an interval that holds one, and its vector; None if iteration left the interval."""
    shift = (low + high) / 2
    x = _start(len(v), 1)[:, 0]
    for _ in range(3):
        x = _solve(factored(v - shift * np.eye(len(v))), x / np.linalg.norm(x), EPS * size)
    x /= np.linalg.norm(x)
    best = None
    for _ in range(12):
        value = float(x @ v @ x)
        if not low < value <= high:
            return None
        residual = float(np.linalg.norm(v @ x - value * x))
        if best is not None and residual >= best[0]:
            break
        best = residual, value, x
        if residual <= EPS * size:
            break
        x = _solve(factored(v - value * np.eye(len(v))), x, EPS * size)
        x /= np.linalg.norm(x)
    return (best[1], best[2]) if best[0] <= 1e-9 * size else None


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; ``most`` of them at most.

    Eigenvalues that rounding can't tell from nothing are left out.
    """
    return _sliced((v + v.T) / 2, most, floor=True)


def _sliced(v: np.ndarray, most: int, *, floor: bool = False) -> tuple[np.ndarray, np.ndarray]:
    n = len(v)
    size = float(np.abs(v).sum(axis=1).max()) if n else 0.0  # no eigenvalue is larger
    if size == 0:
        return np.empty(0), np.empty((n, 0))
    low = 16 * n * EPS * size if floor else -size * 1.01
    near = CLUSTER * size
    alone, close = {}, []  # by the number of larger eigenvalues; (over, up to, low, high) from the largest
    todo = [(low, size * 1.01, above(v, low), 0)]  # the interval with the largest values is last
    while todo:
        low, high, up_to, over = todo.pop()
        if up_to == over or over >= most:
            continue
        if up_to - over == 1:
            found = _refined(v, low, high, size)
            if found is not None and _certified(v, found[0], over, near):
                alone[over] = found
                continue
        if high - low <= near:
            if close and close[-1][1] == over and close[-1][2] - high <= near:  # cut apart by a middle
                over, _, _, high = close.pop()
            close.append((over, up_to, low, high))
            continue
        middle = (low + high) / 2
        between = above(v, middle)
        todo += [(low, middle, up_to, between), (middle, high, between, over)]
    values, vectors = np.empty(n), np.empty((n, n))
    for over, (value, vector) in alone.items():
        values[over], vectors[:, over] = value, vector
    for over, up_to, low, high in close:
        values[over:up_to], vectors[:, over:up_to] = _cluster(v, (low + high) / 2, up_to - over, size)
    count = min(most, max([over + 1 for over in alone] + [c[1] for c in close], default=0))
    return values[:count], vectors[:, :count]


def _certified(v: np.ndarray, value: float, over: int, near: float) -> bool:
    """Whether exactly ``over`` eigenvalues lie above the value's neighbourhood, and one in it."""
    return above(v, value + near) == over and above(v, value - near) == over + 1


def _cluster(v: np.ndarray, centre: float, count: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues that lie close together: sliced again within the span of their vectors."""
    n = len(v)
    factors = factored(v - centre * np.eye(n))
    span = np.linalg.qr(_start(n, count))[0]
    for _ in range(100):
        span = np.linalg.qr(np.column_stack([_solve(factors, c, EPS * size) for c in span.T]))[0]
        apart = v @ span - centre * span
        inner = span.T @ apart
        if np.abs(apart - span @ inner).max() <= 4 * n * EPS * size:
            break
    inner = (inner + inner.T) / 2
    if count == 1 or np.abs(inner - np.eye(count) * np.trace(inner) / count).max() <= 64 * n * EPS * size:
        return centre + np.diag(inner), span  # the same value, as far as one can tell
    values, within = _sliced(inner, count)
    return centre + values, span @ within


# -- rows --------------------------------------------------------------------------


def whitened(embeddings: DataFrame, most: int = 32, *, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every usable vector and leading component of it.

    Rows whose vector is null, empty, or holds a null, NaN or infinite entry are left out; the others
    must have one length, and entries below 2^47, else a ValueError says so. Repeated rows are rows
    of their own; ids may be null. Other columns are left out, whatever their names.
    An entry c counts as floor(64 c) + 1,000,000. Components without variance have no scale
    and are left out, so an empty table, or one of equal vectors, gives no rows.

    Columns: the id, component (from 1, by falling eigenvalue), n (vectors), deviation (squared distance
    from the mean times n squared, exact, decimal(38, 0)), whitened, explained (share of the whole
    variance), identity_error (largest entry of the whitened vectors' covariance minus the
    identity, measured over all rows).
    """
    ship(embeddings.sparkSession)
    vectors = embeddings.select(F.col(vector).cast("array<double>").alias("v__"))
    n, total, covariance = fitted(vectors)
    values, components = leading(covariance, most) if n else (np.empty(0), np.empty((0, 0)))
    scales = components / np.sqrt(values) if len(values) else np.empty((len(total), 0))
    id_field = T.StructField(id_, embeddings.schema[id_].dataType)
    schema = T.StructType(
        [id_field, T.StructField("deviation", WHOLE), T.StructField("white__", T.ArrayType(T.DoubleType()))]
    )
    named = embeddings.select(F.col(vector).cast("array<double>").alias("v__"), id_)
    rows = named.mapInArrow(_whitening(n, total, scales), schema)
    error = _identity_error(vectors, n, total, scales) if len(values) else 0.0
    trace = float(np.trace(covariance)) if n else 1.0
    explained = F.array(*[F.lit(float(e / trace)) for e in values]) if len(values) else F.array(F.lit(0.0))
    return rows.select(id_, "deviation", F.posexplode("white__").alias("at__", "whitened")).select(
        id_,
        (F.col("at__") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at__")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _centred(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Vectors less the nearest integers to the means; as doubles less the rest of the means, too."""
    centre = np.array([round(Fraction(s, n)) for s in total], np.int64)
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    y = x - centre
    return y, y - np.array([float(Fraction(r, n)) for r in rest]), rest


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sums of ``(n y - rest)^2`` over the dimensions, exact."""
    largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
    if largest * largest * y.shape[1] < 2**63:
        apart = n * y - np.array(rest, np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    apart = n * y.astype(object) - np.array(rest, object)
    return pa.array((apart * apart).sum(axis=1).tolist(), pa.decimal128(38, 0))


def _whitening(n: int, total: list[int], scales: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used, x = _vectors(batch.column(0))
            if not len(used):
                continue
            y, centred, rest = _centred(x, n, total)
            white = centred @ scales
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(pa.array(used)),
                    _deviations(y, n, rest),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                ],
                names=[batch.schema.names[1], "deviation", "white__"],
            )

    return run


def _identity_error(vectors: DataFrame, n: int, total: list[int], scales: np.ndarray) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all of them.

    Each task's sums are rounded to 15 places before they are added, so that their order is of no
    consequence.
    """
    size = scales.shape[1]
    schema = "place long, value decimal(38, 15)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, any_ = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            used, x = _vectors(batch.column(0))
            if len(used):
                white = _centred(x, n, total)[1] @ scales
                products, sums, any_ = products + white.T @ white, sums + white.sum(axis=0), True
        if any_:
            values = pa.array(np.concatenate([products.ravel(), sums])).cast(pa.decimal128(38, 15), safe=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), values], names=["place", "value"])

    added = vectors.mapInArrow(run, schema).groupBy("place").agg(F.sum("value").cast("double").alias("value"))
    found = np.zeros(size * size + size)
    for r in added.collect():
        found[r.place] = r.value / n
    means = found[size * size :]
    return float(np.abs(found[: size * size].reshape(size, size) - np.outer(means, means) - np.eye(size)).max())
