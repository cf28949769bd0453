"""Vectors of an Arrow list column as one matrix. The functions run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: entries as doubles, first entry and length of every row, and which rows count.

    Rows that are null or empty, or hold a null or non-finite entry, don't count.
    """
    n = len(column)
    entries = column.values.cast(pa.float64())
    if entries.null_count:
        entries = pc.fill_null(entries, float("nan"))
    entries = entries.to_numpy(zero_copy_only=False)
    bounds = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    first, length = bounds[:-1], np.diff(bounds)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    good = (wrong[bounds[1:]] == wrong[first]) & (length > 0)
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    return entries, first, length, good if n else np.zeros(0, dtype=bool)


def matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that count and have the length, and their entries, one row each."""
    entries, first, lengths, good = usable(column)
    rows = np.flatnonzero(good & (lengths == length))
    return rows, entries[first[rows][:, None] + np.arange(length)]


def lengths(frame: DataFrame, vector_column: str) -> dict[int, int]:
    """How many rows that count have each length; as many entries as there are lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, length, good = usable(batch.column(0))
            found, n = np.unique(length[good], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["length", "n"])

    found = frame.select(F.col(f"`{vector_column}`")).mapInArrow(run, "length bigint, n bigint")
    return dict(found.groupBy("length").agg(F.sum("n")).collect())


def common_length(frame: DataFrame, vector_column: str) -> int:
    """The most frequent length, the smaller of equally frequent ones; 0 without rows that count."""
    return min(((-n, length) for length, n in lengths(frame, vector_column).items()), default=(0, 0))[1]


def fits(largest: float, terms: int, bits: int) -> bool:
    """Whether a sum of so many products of two whole numbers up to ``largest`` stays below 2**bits."""
    return largest * largest * max(terms, 1) < 2.0**bits
