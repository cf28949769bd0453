"""Leading right singular vectors of a sparse matrix by a randomised range finder.

Rows stay sparse: each is a list of (column, weight). A round is one pass over them, in which
every task multiplies its rows by the current block of axes and back, and Spark adds up the
products by column. Besides the rows there is only the block, columns x (axes + spare) numbers;
the columns are a vocabulary of bounded size. Up to ``GRAM_COLUMNS`` columns one pass sums up the
columns' products with each other, columns x columns numbers, and the rounds need no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.session import written

#: axes beyond those asked for, which speed up and steady the rounds
SPARE = 16
#: rounds end when no value moves by more than this share of the largest one, or at the latest
TOLERANCE = 1e-11
ROUNDS = 60
#: at most so many columns have their products summed up once instead of in every round
GRAM_COLUMNS = 1024
#: rows that stand side by side in a task for that
SIDE_BY_SIDE = 512
#: triangular factors that come to the driver for the last merge
FACTORS = 64


def packed_rows(weights: DataFrame, key: str, terms: list[str], term: str = "term", weight: str = "weight") -> DataFrame:
    """One sparse row per key: (key, row: list of (i, w)), i counting ``terms``; written, as every round reads it."""
    index = weights.sparkSession.createDataFrame(list(enumerate(terms)), "i int, term string")
    numbered = weights.select(key, F.col(term).alias("term"), F.col(weight).cast("double").alias("w")).join(F.broadcast(index), "term")
    # a key has each term once, so a list is no longer than the vocabulary
    return written(numbered.groupBy(key).agg(F.collect_list(F.struct("i", "w")).alias("row")), "rows")


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, weight and row number of every entry of a batch."""
    rows = batch.column(0).combine_chunks() if isinstance(batch.column(0), pa.ChunkedArray) else batch.column(0)
    entries = rows.flatten()
    column, weight = entries.field(0).to_numpy(zero_copy_only=False), entries.field(1).to_numpy(zero_copy_only=False)
    return column, weight, np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy(zero_copy_only=False))


def _products(batch: pa.RecordBatch, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a batch, and the rows times the axes."""
    column, weight, number = _entries(batch)
    y = np.empty((len(batch), axes.shape[1]))
    for j in range(axes.shape[1]):
        y[:, j] = np.bincount(number, weight * axes[column, j], len(batch))
    return column, weight, number, y


def _round(rows: DataFrame, axes: np.ndarray) -> np.ndarray:
    """The matrix' Gram times the axes."""
    spark, width = rows.sparkSession, axes.shape[1]
    sent = spark.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        total = np.zeros_like(block)
        for batch in batches:
            column, weight, number, y = _products(batch, block)
            for j in range(width):
                total[:, j] += np.bincount(column, weight * y[number, j], len(block))
        used = np.flatnonzero(total.any(axis=1))
        z = pa.FixedSizeListArray.from_arrays(total[used].ravel(), width).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), z], ["i", "z"])

    parts = rows.select("row").mapInArrow(run, "i int, z array<double>")
    found = parts.groupBy("i").agg(F.array(*[F.sum(F.col("z")[j]) for j in range(width)]).alias("z"))
    out = np.zeros_like(axes)
    for i, z in found.collect():  # one row per term
        out[i] = z
    sent.destroy()
    return out


def _gram(rows: DataFrame, width: int) -> np.ndarray:
    """The matrix' Gram, width x width, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for start in range(0, len(batch), SIDE_BY_SIDE):
                some = batch.slice(start, SIDE_BY_SIDE)
                column, weight, number = _entries(some)
                side = np.bincount(number * width + column, weight, len(some) * width).reshape(len(some), width)
                total += side.T @ side
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    parts = rows.select("row").mapInArrow(run, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # at most GRAM_COLUMNS^2 / 2 rows
    i, j, v = (found[name].to_numpy() for name in ("i", "j", "v"))
    out = np.zeros((width, width))
    out[i, j] = out[j, i] = v
    return out


def _merged(factors: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(factors), mode="r")


def _triangle(rows: DataFrame, axes: np.ndarray) -> np.ndarray:
    """The triangular factor of the rows times the axes: a factor per task, merged in groups, then merged once more."""
    spark, width = rows.sparkSession, axes.shape[1]
    sent = spark.sparkContext.broadcast(axes)
    square: Callable[[bytes], np.ndarray] = lambda held: np.frombuffer(held).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            factor = _merged([factor, _products(batch, sent.value)[3]])
        yield pa.RecordBatch.from_arrays([pa.array([factor.tobytes()], pa.binary())], ["r"])

    def merge(group: pa.Table) -> pa.Table:
        return pa.table({"r": pa.array([_merged([square(r.as_py()) for r in group["r"]]).tobytes()], pa.binary())})

    parts = rows.select("row").mapInArrow(run, "r binary").withColumn("g", F.spark_partition_id() % FACTORS)
    merged = parts.groupBy("g").applyInArrow(lambda group: merge(group.select(["r"])), "r binary").collect()  # at most FACTORS
    sent.destroy()
    return _merged([square(r) for (r,) in merged])


def leading_axes(rows: DataFrame, width: int, dims: int, seed: int = 42) -> np.ndarray:
    """The ``dims`` leading right singular vectors (width x dims) of sparse ``rows`` over ``width`` columns.

    Seeded block power iteration with a block of twice ``dims`` and ``SPARE`` axes, until the leading
    values stand still; then the singular vectors within the block, from the triangular factor of the
    rows' products. With a block as wide as the columns the result is the exact decomposition. Empty
    ``rows`` give the starting axes.
    """
    dims, size = min(dims, width), min(width, 2 * dims + SPARE)
    axes = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    last = np.full(dims, np.inf)
    gram = _gram(rows, width) if size < width <= GRAM_COLUMNS else None
    for _ in range(ROUNDS if size < width else 0):
        product = _round(rows, axes) if gram is None else gram @ axes
        values = np.linalg.eigvalsh(axes.T @ product)[::-1][:dims]
        if values[0] <= 0:
            break
        axes = np.linalg.qr(product)[0]
        if np.abs(values - last).max() <= TOLERANCE * values[0]:
            break
        last = values
    inner = np.linalg.svd(_triangle(rows, axes))[2]
    return axes @ inner[:dims].T


def projected(weights: DataFrame, key: str, terms: list[str], axes: np.ndarray, texts: DataFrame, vector_as: str) -> DataFrame:
    """(key, vector): the weights times the axes; a key of ``texts`` without a weight gets a zero vector."""
    loadings = [(term, axes[i].tolist()) for i, term in enumerate(terms)]
    held = weights.sparkSession.createDataFrame(loadings, "term string, axis array<double>")
    width = axes.shape[1]
    sums = F.array(*[F.sum(F.col("weight") * F.col("axis")[j]) for j in range(width)])
    vectors = weights.join(F.broadcast(held), "term").groupBy(key).agg(sums.alias(vector_as))
    zero = F.array(*[F.lit(0.0)] * width)
    return texts.select(key).join(vectors, key, "left").select(key, F.coalesce(vector_as, zero).alias(vector_as))
