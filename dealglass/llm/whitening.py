"""Embedding whitening: leading components of an exact covariance, unit variance in each.

Vectors are taken in fixed point (``fixed_point``), as whole numbers x, so that sums and
products add up exactly, in any order and however the rows are partitioned:

1. one pass counts the n vectors and sums each dimension (S);
2. one pass sums the products of x - m, where m is the mean rounded to whole numbers; with
   R = S - n * m the covariance is (n * products - R R') / n^2, in integers up to the one
   division, which is the covariance of x - S / n without any rounding of the centre;
3. the driver gets that matrix, whose size is the square of the dimensions whatever the
   number of rows, and finds its leading eigenpairs: Householder reflections make it
   tridiagonal, bisection on Sturm counts gives the eigenvalues, inverse iteration the
   vectors, made orthogonal again within clusters of close eigenvalues;
4. mean and components are sent to all tasks, which project their rows; two more passes over
   the projections give the mean and the centred covariance of the result, whose largest
   difference from the identity is ``identity_error``.

Every vector is in the fit. Left out are null vectors, vectors with a null, NaN or infinite
entry or one whose fixed point exceeds a long, and, since they lack entries or have others,
vectors of another length than the commonest (the longer of two as common). Repeated rows
count each time. Components whose variance is not above rounding (a constant table, fewer
vectors than dimensions) have no whitened value, so there may be fewer than asked for; an
empty table gives an empty result. Columns pass through; ``whitening`` replaces one of that
name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import free_name

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
ROWS = 4096  # vectors in a block of products
EXACT = 2.0**53  # whole numbers a double holds
CLOSE = 1e-3  # eigenvalues this close, against the norm, are one cluster
EPS = np.finfo(float).eps
WHOLE = pa.decimal128(38, 0)


def fixed_point(vector: Column) -> Column:
    """floor(SCALE * c) + OFFSET of each entry as a long; null where there is none."""
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit("inf").cast("double")))
    whole = F.transform(
        entries, lambda c: F.try_add(F.floor(F.lit(float(SCALE)) * c), F.lit(OFFSET).cast("long")))
    return F.when(finite & F.forall(whole, lambda x: x.isNotNull()), whole)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Blocks of rows of the first column, vectors of one length."""
    for batch in batches:
        column = batch.column(0)
        for begin in range(0, len(column), ROWS):
            some = column.slice(begin, ROWS)
            yield some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)


def _most(block: np.ndarray) -> int:
    return max(abs(int(block.max())), abs(int(block.min())))


def _products(block: np.ndarray) -> np.ndarray:
    """Sums of products as whole numbers: by doubles where those are exact."""
    if block.dtype != object and _most(block) ** 2 * len(block) < EXACT:
        near = block.astype(float)
        return (near.T @ near).astype(np.int64).astype(object)
    large = block.astype(object)
    return large.T @ large


def _whole(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], WHOLE)


@dataclass
class Fit:
    """What the projection needs, of a size that depends on the dimensions only."""

    n: int
    centre: np.ndarray  # the mean as whole numbers
    rest: list[int]  # sums of what lies beyond the centre
    eigenvalues: np.ndarray
    components: np.ndarray  # a row for each
    explained: np.ndarray


def usable(df: DataFrame, vector: str, name: str) -> DataFrame:
    """The rows with a vector of the commonest length, in fixed point, as column ``name``."""
    rows = df.withColumn(name, fixed_point(F.col(f"`{vector}`")))
    rows = rows.where(F.col(name).isNotNull() & (F.size(name) > 0))
    lengths = rows.groupBy(F.size(name).alias("size")).count()
    commonest = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size(name) == (commonest[0]["size"] if commonest else -1))


def _sums(rows: DataFrame, name: str) -> tuple[int, list[int]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for block in _blocks(batches):
            n += len(block)
            safe = _most(block) * len(block) < 2**62
            part = block.sum(0).astype(object) if safe else block.astype(object).sum(0)
            total = part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()), _whole([n, *total])], ["i", "value"])

    parts = rows.select(name).mapInArrow(add, "i int, value decimal(38,0)")
    found = dict(parts.groupBy("i").agg(F.sum("value")).collect())
    return int(found.get(-1, 0)), [int(found[i]) for i in range(len(found) - 1)]


def _covariance(
    rows: DataFrame, name: str, n: int, centre: np.ndarray, rest: list[int]
) -> np.ndarray:
    size = len(rest)
    at, by = np.triu_indices(size)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            part = _products(block - centre)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(by, pa.int32()), _whole(total[at, by])],
                ["i", "j", "value"])

    parts = rows.select(name).mapInArrow(multiply, "i int, j int, value decimal(38,0)")
    out = np.zeros((size, size))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():  # size^2 / 2 rows
        out[i, j] = out[j, i] = (n * int(value) - rest[i] * rest[j]) / (n * n)
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: diagonal, off-diagonal, and the unit vectors of the reflections."""
    a = matrix.copy()
    mirrors = []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        size = np.sqrt(v @ v)
        scale = np.abs(v[1:]).max()
        if scale == 0:
            mirrors.append(np.zeros(len(v)))  # nothing to reflect
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.sqrt(v @ v)
        inner = a[k + 1:, k + 1:]
        p = inner @ v
        w = 2 * (p - (v @ p) * v)
        inner -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of ``at``."""
    least = max(np.finfo(float).tiny, EPS * EPS * float((off**2).max(initial=0)))
    below = np.zeros(len(at), int)
    q = np.ones(len(at))
    for k, d in enumerate(diagonal):
        q = d - at - (off[k - 1] ** 2 / q if k else 0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    pad = EPS * len(diagonal) * max(abs(low[0]), abs(high[0]))
    low, high = low - pad, high + pad
    below = len(diagonal) - 1 - np.arange(count)  # eigenvalues under the wanted one
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high) & (high - low > EPS * np.abs(middle) / 4)
        if not open_.any():
            return middle
        over = sturm_counts(diagonal, off, middle) > below
        high = np.where(open_ & over, middle, high)
        low = np.where(open_ & ~over, middle, low)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solves the shifted tridiagonal system by elimination with row exchanges."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    a, b, c = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    x, lower = right.tolist(), off.tolist()
    for k in range(n - 1):
        if abs(lower[k]) > abs(a[k]):  # rows k: (a, b, c); the next: (lower, diagonal, off)
            factor = a[k] / lower[k]
            a[k], b[k], c[k], a[k + 1], b[k + 1] = (
                lower[k], a[k + 1], b[k + 1], b[k] - factor * a[k + 1], -factor * b[k + 1])
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            factor = lower[k] / a[k] if a[k] else 0.0
            a[k + 1] -= factor * b[k]
            x[k + 1] -= factor * x[k]
    out = [0.0] * (n + 2)
    for k in range(n - 1, -1, -1):
        pivot = a[k] if abs(a[k]) > EPS * norm else EPS * norm
        out[k] = (x[k] - b[k] * out[k + 1] - c[k] * out[k + 2]) / pivot
    return np.array(out[:n])


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling eigenvalues, by inverse iteration."""
    n, norm = len(diagonal), max(np.abs(values).max(initial=0), np.finfo(float).tiny)
    random = np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * norm:
            cluster = k
        shift = min(value, shift - 10 * EPS * norm) if k > cluster else value
        v = random.uniform(-1, 1, n)
        for _ in range(6):
            v = _solve(diagonal, off, shift, v / np.sqrt(v @ v))
            v /= np.abs(v).max()
            for _ in range(2):  # twice, for vectors that are nearly inside the cluster
                for other in found[cluster:k]:
                    v -= (other @ v) * other
        found.append(v / np.sqrt(v @ v))
    return np.array(found).reshape(len(values), n)


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit vectors (rows), of a symmetric matrix."""
    count = min(count, len(matrix))
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(count), np.eye(len(matrix))[:count]
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, count)
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v, part = mirrors[k], vectors[:, k + 1:]
        part -= 2 * np.outer(part @ v, v)
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(1)[:, None], 1)
    return values * scale, vectors * np.where(largest < 0, -1.0, 1.0)


def fit(rows: DataFrame, name: str, components: int = COMPONENTS) -> Fit | None:
    """Learns from every vector of ``usable``; None where there is none."""
    n, sums = _sums(rows, name)
    if not n:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    centre = np.array(centre, np.int64)
    covariance = _covariance(rows, name, n, centre, rest)
    values, vectors = leading_eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    real = values > len(covariance) * EPS * max(values.max(), 0)
    return Fit(n, centre, rest, values[real], vectors[real],
               values[real] / trace if trace > 0 else values[real])


def _centred(fitted: Fit, block: np.ndarray) -> np.ndarray:
    return (block - fitted.centre) - np.array([r / fitted.n for r in fitted.rest])


def _deviations(fitted: Fit, block: np.ndarray) -> list[Decimal]:
    """Sum over dimensions of (n * x - S)^2, exact."""
    off = block - fitted.centre
    most = fitted.n * (_most(off) + 1)
    if most**2 * off.shape[1] >= 2**63:
        off = off.astype(object)
    off = off * fitted.n - np.array(fitted.rest, off.dtype)
    return [Decimal(int(v)) for v in (off * off).sum(1)]


def project(rows: DataFrame, name: str, fitted: Fit) -> DataFrame:
    """All columns but ``name``, and ``whitening``: deviation and the whitened values."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    @F.pandas_udf("deviation decimal(38,0), whitened array<double>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        to_unit = fitted.components.T / np.sqrt(fitted.eigenvalues)
        for batch in batches:
            parts = [np.stack(batch.iloc[i:i + ROWS].to_list()) for i in range(0, len(batch), ROWS)]
            yield pd.DataFrame({
                "deviation": [d for part in parts for d in _deviations(fitted, part)],
                "whitened": [w for part in parts for w in _centred(fitted, part) @ to_unit],
            })

    return rows.withColumn("whitening", apply.asNondeterministic()(F.col(name))).drop(name)


def identity_error(projected: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the whitened covariance, centred first, less the identity."""
    size = len(fitted.eigenvalues)
    white = projected.select("whitening.whitened")

    def total(of) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = sum(of(block) for block in _blocks(batches))
            if np.ndim(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(out.size), pa.int32()), pa.array(out.ravel())], ["i", "value"])

        parts = white.mapInArrow(add, "i int, value double")
        found = dict(parts.groupBy("i").agg(F.sum("value")).collect())  # size^2 rows at most
        return np.array([found[i] for i in range(len(found))]) / fitted.n

    if not size:
        return 0.0
    mean = total(lambda block: block.sum(0))
    covariance = total(lambda block: (block - mean).T @ (block - mean))
    return float(np.abs(covariance.reshape(size, size) - np.eye(size)).max())


def whiten(
    df: DataFrame, vector: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Fit | None, float]:
    """The rows with a usable vector and their ``whitening``; the fit; its identity error."""
    name = free_name(df, "fixed")
    rows = usable(df, vector, name)
    fitted = fit(rows, name, components)
    if fitted is None:
        nothing = F.lit(None).cast("struct<deviation:decimal(38,0),whitened:array<double>>")
        return rows.withColumn("whitening", nothing).drop(name), None, 0.0
    projected = project(rows, name, fitted)
    return projected, fitted, identity_error(projected, fitted)
