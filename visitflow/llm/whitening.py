"""Embedding whitening by a polarisation covariance.

Entries c become integers x = floor(64 c) + 1000000. One pass gives the exact
sums S; a second one, over values centred at the whole number m nearest below
S / n, gives the exact sums of squares of every dimension and of the sum of
every pair of dimensions. With r = S - n m the variances are exact fractions,

    n^2 Var(x_i)       = n sum (x_i - m_i)^2 - r_i^2
    n^2 Var(x_i + x_j) = n sum (x_i - m_i + x_j - m_j)^2 - (r_i + r_j)^2

and Cov(x_i, x_j) = (Var(x_i + x_j) - Var(x_i) - Var(x_j)) / 2 has no rounding
before it becomes a double. Tasks send one row per pair of dimensions, so what
meets on the driver is D (D + 1) / 2 sums, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.vectors import matrices

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LIMIT = 2.0 ** 61  # entries with |64 c| from here on have no room in 64 bits
ROWS = 1 << 14  # rows worked on at once
SMALL = 1 << 20  # centred values below this are squared in 64 bits
LIMB = 40
LIMBS = 5
LOW = (1 << LIMB) - 1
# Eigenvalues below this share of the largest are rounding of the covariance.
FLOOR = 1e-13


def scaled(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix of x) for each vector length."""
    for rows, c in matrices(column):
        x = np.floor(c * SCALE)
        fits = (np.abs(x) < LIMIT).all(axis=1)
        yield rows[fits], x[fits].astype(np.int64) + SHIFT


def _limbs(value: int) -> list[int]:
    """``value`` as LIMBS numbers of LIMB bits (the last one signed), whose
    sums over many tasks fit 64 bits."""
    return [(value >> (LIMB * k)) & LOW for k in range(LIMBS - 1)] + [value >> (LIMB * (LIMBS - 1))]


_LIMB_COLUMNS = [f"s{k}" for k in range(LIMBS)]
_LIMB_SCHEMA = ", ".join(f"{c} bigint" for c in _LIMB_COLUMNS)


def _limb_sums() -> list:
    return [F.sum(c).alias(c) for c in _LIMB_COLUMNS]


def _value(row) -> int:
    return sum(int(row[c]) << (LIMB * k) for k, c in enumerate(_LIMB_COLUMNS))


def _exact_sums(x: np.ndarray) -> list[int]:
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(lo) for h, lo in zip(high, low)]


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, i, limbs) per vector length: the sums S_i, and at i = -1 the rows."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        for rows, x in scaled(batch.column("vector")):
            sums = [len(rows), *_exact_sums(x)]
            total[x.shape[1]] = [a + b for a, b in zip(total.get(x.shape[1], [0] * len(sums)), sums)]
    for size, sums in total.items():
        table = [(size, i - 1, *_limbs(s)) for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*table)], ["size", "i", *_LIMB_COLUMNS])


def _square_sums(y: np.ndarray) -> np.ndarray:
    """Sums of (y_i + y_j)^2 for i < j, and of y_i^2 on the diagonal."""
    out = np.zeros((y.shape[1], y.shape[1]), y.dtype)
    for i in range(y.shape[1]):
        out[i, i] = (y[:, i] * y[:, i]).sum()
        both = y[:, i + 1:] + y[:, i:i + 1]
        out[i, i + 1:] = (both * both).sum(axis=0)
    return out


def _squares(centre: np.ndarray) -> Callable:
    """(i, j, limbs) per task: the exact sums of squares of centred values."""
    size = len(centre)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for batch in batches:
            for _, x in scaled(batch.column("vector")):
                for at in range(0, len(x) if x.shape[1] == size else 0, ROWS):
                    y = x[at:at + ROWS] - centre
                    small = (np.abs(y) < SMALL).all(axis=1)
                    total += _square_sums(y[small]).astype(object)
                    if not small.all():
                        total += _square_sums(y[~small].astype(object))
        i, j = np.triu_indices(size)
        limbs = [_limbs(int(s)) for s in total[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *[pa.array(c, pa.int64()) for c in zip(*limbs)]], ["i", "j", *_LIMB_COLUMNS])

    return run


class Whitening(NamedTuple):
    """What a fit gives: n rows, the sums S split as n * centre + rest, unit
    eigenvectors as columns, their eigenvalues and the covariance's trace."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components, each over the root of its eigenvalue."""
        return ((x - self.centre) - self.rest / self.n) @ (self.vectors / np.sqrt(self.values))


def _eigen(exact: list[list[Fraction]], components: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors; the eigenvalues are Rayleigh
    quotients in extended precision, so small ones keep their digits."""
    v = np.array([[float(c) for c in row] for row in exact])
    rest = np.array([[float(c - Fraction(float(c))) for c in row] for row in exact])
    _, vectors = np.linalg.eigh(v)
    vectors = vectors[:, ::-1]
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(v))] < 0, -1.0, 1.0)
    wide = vectors.astype(np.longdouble)
    values = (wide * ((v.astype(np.longdouble) + rest) @ wide)).sum(axis=0) / (wide * wide).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLOOR * max(float(values.max()), 0.0)]
    return values[order].astype(float), np.ascontiguousarray(vectors[:, order])


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a vector column; None where no vector remains or all
    are equal. Vectors that are NULL or empty, hold NULL or non-finite entries
    or entries of 2^55 and more do not count; where lengths differ the most
    frequent one counts (ties: the longer)."""
    rows = vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))
    found = rows.mapInArrow(_sums, f"size bigint, i bigint, {_LIMB_SCHEMA}").groupBy("size", "i").agg(*_limb_sums())
    most = found.where("i = -1").orderBy(F.desc("s4"), F.desc("s3"), F.desc("s2"), F.desc("s1"), F.desc("s0"), F.desc("size")).limit(1).collect()
    if not most:
        return None
    size, n = most[0]["size"], _value(most[0])
    sums = [_value(r) for r in sorted(found.where((F.col("size") == size) & (F.col("i") >= 0)).collect(), key=lambda r: r["i"])]
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    square = {(r["i"], r["j"]): _value(r) for r in rows.mapInArrow(_squares(centre), f"i bigint, j bigint, {_LIMB_SCHEMA}")
              .groupBy("i", "j").agg(*_limb_sums()).collect()}
    own = [n * square[i, i] - rest[i] ** 2 for i in range(size)]
    exact = [[Fraction(0)] * size for _ in range(size)]
    for i in range(size):
        exact[i][i] = Fraction(own[i], n * n)
        for j in range(i + 1, size):
            both = n * square[i, j] - (rest[i] + rest[j]) ** 2
            exact[i][j] = exact[j][i] = Fraction(both - own[i] - own[j], 2 * n * n)
    if not any(own):
        return None
    values, columns = _eigen(exact, components)
    return Whitening(n, centre, np.array(rest, float), columns, values, float(sum(exact[i][i] for i in range(size))))


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the
    identity, from the whitened values themselves."""
    k = len(model.values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, squares = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in scaled(batch.column("vector")):
                for at in range(0, len(x) if x.shape[1] == len(model.centre) else 0, ROWS):
                    w = model.project(x[at:at + ROWS])
                    ones += w.sum(axis=0)
                    squares += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + k * k)), pa.array(np.concatenate([ones, squares.ravel()]))], ["at", "value"])

    rows = vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))
    got = rows.mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
    sums = np.array([r["value"] for r in got])
    mean = sums[:k] / model.n
    return float(np.abs(sums[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sums over dimensions of (n x - S)^2, exact; NULL beyond 64 bits."""
    y = x - model.centre
    most = model.n * (float(np.abs(y).max(initial=0)) + 1)
    if most * most * x.shape[1] < 2.0 ** 62:
        z = model.n * y - model.rest.astype(np.int64)
        return pa.array((z * z).sum(axis=1))
    z = model.n * y.astype(object) - np.array([int(r) for r in model.rest], object)
    return pa.array([int(s) if s < 1 << 63 else None for s in (z * z).sum(axis=1)], pa.int64())


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained), one row for each
    counted vector and component. Rows that repeat an id or a vector each come
    back, a NULL id stays NULL; without a model there are no rows. ``deviation``
    is NULL where the exact sum passes 64 bits."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            for rows, x in scaled(batch.column("vector")):
                for at in range(0, len(x) if x.shape[1] == len(model.centre) else 0, ROWS):
                    part = x[at:at + ROWS]
                    each = pa.array(np.repeat(np.arange(len(part)), k))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("vec_id").take(pa.array(rows[at:at + ROWS])).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(len(each), model.n)), _deviations(part, model).take(each),
                        pa.array(model.project(part).ravel()), pa.array(np.tile(model.values / model.trace, len(part))),
                    ], ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, schema)
