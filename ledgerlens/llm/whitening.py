"""Whitening of vectors, with the leading components found by FEAST contour integration.

Vectors become integers (256ths), so sums and products over the table are exact
and the covariance is right to the last bit however the rows are dealt. Spark
adds up the different vectors of each task, then their products about a whole
number next to the mean; one matrix of the vectors' width reaches the driver.

Its largest eigenvalues are fenced in by intervals. For each interval, a
quadrature of the resolvent along a circle through its ends (complex shifted
solves) projects a few random directions onto the eigenvectors inside, and
Rayleigh-Ritz extracts them (Polizzi, 2009). How many there must be is known
from inertia: the negative pivots of the shifted matrix count the eigenvalues
below the shift. A search that finds fewer goes on with more directions.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.columns import column
from ledgerlens.sources import Scratch

COMPONENTS = 4
# Quadrature nodes on the upper half of a circle, and the widest ratio between the ends of an interval.
_NODES, _RATIO = 8, 8.0
_ROUNDS = 40
# Low part of an exact sum that may pass 64 bits.
_LOW = 40
_OUT = "vec_id long, whitened array<double>, deviation long"


@dataclass(frozen=True)
class Fit:
    """What the different vectors say: their number, sums by dimension, components (a column each) and eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float


def whiten(table: DataFrame, scratch: Scratch, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component up to k.

    Usable is a vector that is neither null nor empty and holds neither null nor
    non-finite entries; the others give no row, nor do vectors of another length
    than most (of lengths that tie, the longest). An entry c counts as
    floor(256 c), at the ends of 64 bits where it lies beyond. Each different
    vector is fitted once, every row is whitened, so rows that repeat give equal
    rows. A null id stays null. Directions without variance have no component:
    a table of one different vector gives no rows, as does an empty one.
    `deviation` is null where it needs more than 64 bits. Further columns are
    not read. `explained` is the share of the variance; `identity_error` is the
    largest entry by which the covariance of the whitened different vectors
    differs from the identity.
    """
    vectors = scratch.write(_integers(table, id_col, vector_col), "integers")
    different = scratch.write(vectors.select("x").distinct(), "different")
    fitted = fit(different, k)
    if not len(fitted.values):
        fitted = Fit(fitted.n, fitted.sums, np.zeros((0, 1)), np.ones(1), 1.0)
        return _described(vectors.limit(0).select("vec_id", F.array().cast("array<double>").alias("whitened"), F.lit(0).cast("long").alias("deviation")), fitted, 0.0)
    error = identity_error(different, fitted)
    return _described(vectors.mapInArrow(_projecting(fitted, "vec_id"), _OUT), fitted, error)


def _described(projected: DataFrame, fitted: Fit, error: float) -> DataFrame:
    shares = F.array(*(F.lit(float(v / fitted.trace)) for v in fitted.values)).cast("array<double>")
    rows = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def _integers(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the usable rows."""
    rows = table.select(column(table, id_col).cast("long").alias("vec_id"), column(table, vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    length = lengths[0].length if lengths else 0
    x = F.transform("vector", lambda c: F.floor(c * F.lit(256.0)).cast("long"))
    return rows.filter(F.size("vector") == length).select("vec_id", x.alias("x"))


def fit(different: DataFrame, k: int) -> Fit:
    """Components of the covariance of the vectors x, each of which is there once."""
    width = different.select(F.size("x").alias("d")).limit(1).collect()
    if not width:
        return Fit(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    d = width[0].d
    totals = _added(different, _sums, d + 1)
    n, sums = totals[0], totals[1:]
    # Products are taken of whole numbers about the mean: exact, and small where the vectors lie close together.
    middle = [(2 * s + n) // (2 * n) for s in sums]
    products = _added(different, functools.partial(_products, middle=middle), d * (d + 1) // 2)
    rest = [s - n * m for s, m in zip(sums, middle)]
    covariance = np.zeros((d, d))
    for (i, j), p in zip(zip(*np.triu_indices(d)), products):
        covariance[i, j] = covariance[j, i] = Fraction(n * p - rest[i] * rest[j], n * n)
    trace = float(np.trace(covariance))
    components, values = leading(covariance, k)
    return Fit(n, tuple(sums), components, values, trace)


def _exact(x: np.ndarray) -> np.ndarray:
    """Integers whose sums of products stay exact: doubles where they surely do, Python's integers elsewhere."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return x.astype(np.float64) if most * most * max(1, len(x)) < 1 << 53 else x.astype(object)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch["x"]
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _sums(x: np.ndarray) -> list[int]:
    return [len(x), *(int(s) for s in _exact(x).sum(axis=0))]


def _products(x: np.ndarray, middle: list[int]) -> list[int]:
    near = max((abs(m) for m in middle), default=0) < 1 << 61 and (not x.size or max(abs(int(x.max())), abs(int(x.min()))) < 1 << 61)
    y = _exact(x - np.array(middle)) if near else x.astype(object) - np.array(middle, dtype=object)
    gram = y.T @ y
    return [int(v) for v in gram[np.triu_indices(len(middle))]]


def _added(rows: DataFrame, measure, width: int) -> list[int]:
    """The sums over all rows of what `measure` gives for a batch, exact at any size: tasks send one row per number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            if len(batch):
                total = [a + b for a, b in zip(total, measure(_matrix(batch)))]
        places = pa.array(range(width), pa.int32())
        high = pa.array([t >> _LOW for t in total], pa.decimal128(38, 0))
        low = pa.array([t & (1 << _LOW) - 1 for t in total], pa.int64())
        yield pa.RecordBatch.from_arrays([places, high, low], names=["place", "high", "low"])

    parts = rows.mapInArrow(run, "place int, high decimal(38,0), low long")
    found = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    total = [0] * width
    for r in found:
        total[r.place] = (int(r.high) << _LOW) + int(r.low)
    return total


def _projecting(fitted: Fit, key: str | None):
    """A task function: whitened values, and with a key also the exact squared distance from the mean times n."""
    n, sums = fitted.n, fitted.sums
    weights = fitted.components / np.sqrt(fitted.values)
    most_sum = max(abs(s) for s in sums)

    def centred(x: np.ndarray) -> np.ndarray:
        most = max(abs(int(x.max())), abs(int(x.min())))
        reach = n * most + most_sum
        if reach * reach * len(sums) < 1 << 63:
            return n * x - np.array(sums)
        return x.astype(object) * n - np.array(sums, dtype=object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            z = centred(_matrix(batch))
            flat = ((z / n).astype(np.float64) @ weights).ravel()
            places = np.arange(len(z) + 1, dtype=np.int32) * weights.shape[1]
            whitened = pa.ListArray.from_arrays(places, flat)
            squares = [int(s) for s in (z * z).sum(axis=1)]
            deviation = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
            yield pa.RecordBatch.from_arrays([batch[key], whitened, deviation], names=["vec_id", "whitened", "deviation"])

    return run


def identity_error(different: DataFrame, fitted: Fit) -> float:
    """The largest entry by which the covariance of the whitened vectors differs from the identity."""
    k = len(fitted.values)
    project = _projecting(fitted, "none")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        named = (pa.RecordBatch.from_arrays([b["x"], pa.nulls(len(b), pa.int64())], names=["x", "none"]) for b in batches)
        for batch in project(named):
            w = batch["whitened"].flatten().to_numpy().reshape(-1, k)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["place", "value"])

    parts = different.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros((k + 1) * k)
    for r in parts.collect():
        total[r.place] = r.value
    total = total.reshape(k + 1, k) / fitted.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit eigenvectors as columns, eigenvalues) of the k largest eigenvalues above rounding, falling."""
    d = len(matrix)
    scale = float(np.trace(matrix))
    if not scale > 0:
        return np.zeros((d, 0)), np.zeros(0)
    a = matrix / scale
    inertia = Inertia(a)
    # No eigenvalue of the scaled matrix is above one; those below the floor are rounding.
    floor = 4 * d * np.finfo(float).eps
    k = min(k, inertia.above(floor))
    low, high = floor, 1.0 + 1e-6
    while inertia.above(low) > k and high - low > 1e-3 * high:
        middle = (low + high) / 2 if high < 4 * low else float(np.sqrt(low * high))
        if inertia.above(middle) >= k:
            low = middle
        else:
            high = middle
    bounds = _fences(inertia, max(floor, _gap(inertia, low, floor)))
    basis = [_project(a, low, high, inertia.above(low) - inertia.above(high)) for low, high in bounds]
    # Vectors of neighbouring intervals are made orthogonal by a last Rayleigh-Ritz step on all of them.
    vectors, values = _ritz(a, np.linalg.qr(np.concatenate(basis, axis=1))[0])
    order = np.argsort(values)[::-1][:k]
    return vectors[:, order], values[order] * scale


class Inertia:
    """Counts eigenvalues of a symmetric matrix on either side of a shift.

    The matrix is brought to tridiagonal form by reflections once; the pivots of
    the form less the shift have as many negative ones as there are eigenvalues
    below it (Sylvester).
    """

    def __init__(self, matrix: np.ndarray):
        a, d = matrix.copy(), len(matrix)
        for i in range(d - 2):
            v = a[i + 1 :, i].copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            size = v @ v
            if size == 0:
                continue
            # a <- H a H with H = 1 - 2 v v' / v'v on the rows and columns below i.
            rows = a[i + 1 :]
            rows -= np.outer(2 * v / size, v @ rows)
            columns = a[:, i + 1 :]
            columns -= np.outer(columns @ v, 2 * v / size)
        self.diagonal, self.beside = np.diag(a).copy(), np.diag(a, -1).copy()

    def above(self, shift: float) -> int:
        """How many eigenvalues are above the shift."""
        below, pivot = 0, 1.0
        tiny = np.finfo(float).tiny
        for i, x in enumerate(self.diagonal - shift):
            pivot = x - (self.beside[i - 1] ** 2 / pivot if i else 0.0)
            if abs(pivot) < tiny:
                pivot = -tiny
            below += pivot < 0
        return len(self.diagonal) - below


def _gap(inertia: Inertia, at: float, floor: float) -> float:
    """A shift a little below `at` with no eigenvalue next to it, if there is one."""
    for part in (0.98, 0.95, 0.9, 0.8, 0.7, 0.5):
        if at * part > floor and inertia.above(at * part * 0.99) == inertia.above(at * part * 1.01):
            return at * part
    return at * 0.9


def _fences(inertia: Inertia, low: float) -> list[tuple[float, float]]:
    """Intervals from `low` to the top that hold eigenvalues, their ends in gaps where there are some."""
    found, high = [], 1.0 + 1e-6
    while high > low:
        start = low if high / _RATIO <= low * 1.5 else _gap(inertia, high / _RATIO, low)
        if inertia.above(start) > inertia.above(high):
            found.append((start, high))
        high = start
    return found


def _project(a: np.ndarray, low: float, high: float, wanted: int) -> np.ndarray:
    """An orthonormal basis of the eigenvectors whose `wanted` eigenvalues lie between the ends."""
    d, random = len(a), np.random.default_rng([len(a), wanted])
    middle, radius = (low + high) / 2, (high - low) / 2
    size, nodes = min(d, wanted + wanted // 2 + 4), _NODES
    nearest = np.inf
    basis = random.normal(size=(d, size))
    for turn in range(_ROUNDS):
        x, w = np.polynomial.legendre.leggauss(nodes)
        angles = np.pi / 2 * (x + 1)
        filtered = np.zeros_like(basis)
        for angle, weight in zip(angles, w):
            step = radius * np.exp(1j * angle)
            filtered += (weight / 2 * step * np.linalg.solve((middle + step) * np.eye(d) - a, basis.astype(complex))).real
        basis = np.linalg.qr(filtered)[0]
        vectors, values = _ritz(a, basis)
        inside = (values > low) & (values <= high)
        if inside.sum() == wanted:
            found = vectors[:, inside]
            residual = np.linalg.norm(a @ found - found * values[inside], axis=0).max()
            # Rounding bounds the residual; it is there once a round no longer betters it.
            if residual < 1e-15 * d or (residual < 1e-12 and residual > nearest / 4):
                return found
            nearest = residual
        basis = vectors
        if turn % 10 == 9:
            # Missed or slow: more directions and a sharper filter; all directions together miss nothing.
            size, nodes = min(d, 2 * size), nodes + 4
            basis = np.concatenate([vectors, random.normal(size=(d, size - vectors.shape[1]))], axis=1)
    raise ArithmeticError(f"inertia counts {wanted} eigenvalues in ({low}, {high}], {int(inside.sum())} were found")


def _ritz(a: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: the vectors of a space that are closest to eigenvectors, and their values."""
    small = basis.T @ a @ basis
    values, turned = np.linalg.eigh((small + small.T) / 2)
    return basis @ turned, values
