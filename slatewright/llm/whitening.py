"""Whitening of embeddings: components of the covariance by Cholesky and Jacobi, not by an eigensolver.

1. Entries become whole numbers floor(scale x entry) + offset. Two passes over the vectors add up,
   exactly, the sums of each dimension and the products of entries less the rounded mean. Only the
   sums, as many as dimensions squared, come to the driver.
2. The scatter, corrected there by the fraction the rounding left, is exact until its one division.
   Pivoted Cholesky splits it into a triangular factor, whose rank is the scatter's.
3. One-sided Jacobi rotates pairs of columns of that factor until all are orthogonal: their squared
   norms are the eigenvalues, and the normalised columns, in the order of the dimensions again, are
   the components. No product of the factor with itself is formed, so small eigenvalues stay exact.
4. A third pass measures the covariance of the whitened vectors, a last one returns them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.llm import dense_rows

WIDE = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """What the vectors gave: whole sums, and the components by falling eigenvalue."""

    n: int
    length: int
    scale: int
    offset: int
    sums: list[int]  # of each dimension, exact
    values: np.ndarray  # eigenvalues
    components: np.ndarray  # one column each
    trace: float
    identity_error: float | None = None

    @property
    def near(self) -> np.ndarray:
        """The rounded mean of each dimension."""
        return np.array([round_div(s, self.n) for s in self.sums], dtype=np.int64)


def round_div(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def whole(entries: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """floor(scale x entry) + offset as 64-bit numbers."""
    x = np.floor(entries * scale)
    if x.size and np.abs(x).max() >= 2.0**62:
        raise OverflowError("an entry times the scale is beyond 64 bits")
    return x.astype(np.int64) + offset


def gram(z: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
    """Exact sums of products of columns, as 64-bit numbers or, where these don't reach, as Python's."""
    largest = float(np.abs(z).max()) if z.size else 0.0
    if dense_rows.fits(largest, len(z), 53):
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if dense_rows.fits(largest, len(z), 63):
        return z.T @ z
    return z.astype(object).T @ z.astype(object)


def _summed(frame: DataFrame) -> dict[int, int]:
    """cell -> sum of the parts the tasks give."""
    return {cell: int(s) for cell, s in frame.groupBy("cell").agg(F.sum("s").alias("s")).collect()}


def _cells(values, n: int) -> pa.RecordBatch:
    """Cells 0, 1, ... with the values; the number of rows as the last."""
    cells = [Decimal(int(v)) for v in values] + [Decimal(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int64()), pa.array(cells, WIDE)], ["cell", "s"])


def _added(total, more):
    """Sums that go over to Python's numbers before 64 bits could overflow."""
    if total is None:
        return more
    if total.dtype == object or more.dtype == object or max(np.abs(total).max(), np.abs(more).max()) >= 2**61:
        return total.astype(object) + more.astype(object)
    return total + more


def column_sums(vectors: DataFrame, length: int, scale: int, offset: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            rows, entries = dense_rows.matrix(batch.column(0), length)
            if len(rows):
                x = whole(entries, scale, offset)
                wide = float(np.abs(x).max()) * len(x) >= 2.0**62
                total, n = _added(total, (x.astype(object) if wide else x).sum(axis=0)), n + len(rows)
        if n:
            yield _cells(total, n)

    found = _summed(vectors.mapInArrow(run, "cell bigint, s decimal(38,0)"))
    return found.get(length, 0), [found.get(k, 0) for k in range(length)]


def scatter(vectors: DataFrame, length: int, scale: int, offset: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance, divisor n: centred on the rounded mean before multiplying, then corrected exactly."""
    near = np.array([round_div(s, n) for s in sums], dtype=np.int64)
    upper = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows_seen = None, 0
        for batch in batches:
            rows, entries = dense_rows.matrix(batch.column(0), length)
            if len(rows):
                total = _added(total, gram(whole(entries, scale, offset) - near)[upper])
                rows_seen += len(rows)
        if rows_seen:
            yield _cells(total, rows_seen)

    found = _summed(vectors.mapInArrow(run, "cell bigint, s decimal(38,0)"))
    products = np.zeros((length, length), dtype=object)
    products[upper] = [found.get(k, 0) for k in range(len(upper[0]))]
    products[upper[::-1]] = products[upper]
    rest = np.array([s - n * int(m) for s, m in zip(sums, near)], dtype=object)  # sums about the rounded mean
    return ((n * products - np.outer(rest, rest)) / (n * n)).astype(np.float64)


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the dimensions and lower triangular factor: v[order][:, order] = factor factor', one column per rank."""
    rest, n = v.astype(np.float64).copy(), len(v)
    order, factor = np.arange(n), np.zeros((n, n))
    least = n * np.finfo(float).eps * max(np.diag(rest).max(), 0) if n else 0
    for k in range(n):
        p = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[p, p] <= least:
            return order, factor[:, :k]
        for a in (rest, factor):
            a[[k, p]] = a[[p, k]]
        rest[:, [k, p]] = rest[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return order, factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated in pairs until they are orthogonal.

    All pairs of a sweep are met in rounds of disjoint pairs, each rotated at once.
    """
    g, r = factor.copy(), factor.shape[1]
    if r < 2:
        return g
    ring = list(range(r)) + [-1] * (r % 2)
    half = len(ring) // 2
    tiny = np.finfo(float).eps * np.sqrt(len(factor))
    for _ in range(sweeps):
        rotated = False
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[:half], ring[half:][::-1]) if a >= 0 and b >= 0]
            i, j = np.array(pairs).T
            left, right = g[:, i], g[:, j]
            a, b, c = (left * left).sum(axis=0), (right * right).sum(axis=0), (left * right).sum(axis=0)
            turn = np.abs(c) > tiny * np.sqrt(a * b)
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            g[:, i], g[:, j] = left * cos - right * sin, left * sin + right * cos
            rotated |= bool(turn.any())
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if not rotated:
            break
    return g


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and unit eigenvectors as columns, of a positive semidefinite matrix."""
    order, factor = pivoted_cholesky(v)
    g = one_sided_jacobi(factor)
    norms = np.sqrt((g * g).sum(axis=0))
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(g)
    vectors[order] = g / norms
    return (norms * norms)[by_size], vectors[:, by_size]


def fitted(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, vector_column: str = "embedding") -> Whitening:
    """Sums, eigenvalues and components of all vectors, and how far the whitened ones are from unit covariance."""
    own = vectors.select(F.col(f"`{vector_column}`").alias("vector"))
    length = dense_rows.common_length(own, "vector")
    n, sums = column_sums(own, length, scale, offset) if length else (0, [])
    if not n:
        return Whitening(0, length, scale, offset, [], np.zeros(0), np.zeros((length, 0)), 0.0)
    v = scatter(own, length, scale, offset, n, sums)
    values, found = eigen(v)
    model = Whitening(n, length, scale, offset, sums, values[:components], found[:, :components], float(np.trace(v)))
    model.identity_error = _identity_error(own, model)
    return model


def _projected(model: Whitening, x: np.ndarray) -> np.ndarray:
    """x less the mean on every component, over the root of its eigenvalue."""
    near = model.near
    fraction = np.array([(s - model.n * int(m)) / model.n for s, m in zip(model.sums, near)])
    return ((x - near) - fraction) @ (model.components / np.sqrt(model.values))


def _identity_error(own: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    k = len(model.values)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            rows, entries = dense_rows.matrix(batch.column(0), model.length)
            if len(rows):
                w = _projected(model, whole(entries, model.scale, model.offset))
                sums, products = sums + w.sum(axis=0), products + w.T @ w
        cells = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int64()), pa.array(cells)], ["cell", "s"])

    rows = own.mapInArrow(run, "cell bigint, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    cells = np.zeros(k + k * k)
    for cell, s in rows:
        cells[cell] = s
    mean = cells[:k] / model.n  # zero but for rounding, as the vectors are centred before
    return float(np.abs(cells[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def deviations(model: Whitening, x: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - sum) squared of every row, exact."""
    near = model.near
    rest = [s - model.n * int(m) for s, m in zip(model.sums, near)]
    z = x - near
    largest = float(np.abs(z).max()) * model.n + max(map(abs, rest)) if z.size else 0.0
    if dense_rows.fits(largest, model.length, 63):
        y = model.n * z - np.array(rest, dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    y = model.n * z.astype(object) - np.array(rest, dtype=object)
    return (y * y).sum(axis=1).tolist()


def whitened(vectors: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    One row for each vector that counts and each component, which are as many as the covariance has
    eigenvalues above zero, at most those of the model. Null and empty vectors, vectors with a null
    or non-finite entry, and vectors of another than the most frequent length (the smaller of equally
    frequent ones) take no part. Repeated rows all count and stay; a null id stays null. Without
    vectors, or when all are equal, there are no rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            rows, entries = dense_rows.matrix(batch.column(1), model.length)
            if not len(rows) or not k:
                continue
            x = whole(entries, model.scale, model.offset)
            size = len(rows) * k
            own = [Decimal(d) for d in deviations(model, x) for _ in range(k)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(size, model.n, dtype=np.int64)),
                    pa.array(own, WIDE),
                    pa.array(_projected(model, x).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(rows))),
                    pa.array(np.full(size, model.identity_error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    own = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
