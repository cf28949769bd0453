"""Quality of texts by a factorisation machine over hashed words, structure and metadata.

score(x) = w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j. The pair term is computed in linear
time as half of the sum over factors of (sum v x)^2 - sum (v x)^2.

Inputs: ``2**bits`` hashed words of the lower-cased text, structure statistics (shares of
symbols, capitals, digits and pipes, repetition, lengths) and the text's size class. Labels,
language, source and ids are never inputs. The machine is fitted on at most ``sample`` labelled
rows, those with the smallest hash of their id; all else runs over every row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.llm import textbytes as tb

BITS = 13
FACTORS = 8
SAMPLE = 6_000
EPOCHS = 12
STATISTICS = ("symbols", "capitals", "digits", "pipes", "marks", "distinct", "commonest", "word_length", "line_length", "size", "none")
SYMBOLS = b"#*$%&|<>"
SIZES = 8


def width_of(bits: int) -> int:
    return (1 << bits) + len(STATISTICS) + SIZES


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (column, value, first entry of each text) of a block of texts."""
    n = len(offsets) - 1
    low = tb.LOWER[data]
    starts, ends, first = tb.words(low, offsets, tb.UNSPACED)
    hashed = (tb.range_hashes(low, starts, ends) >> np.uint64(64 - bits)).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(first))
    cells, counts = np.unique((text << bits) | hashed, return_counts=True)
    row, column = cells >> bits, cells & ((1 << bits) - 1)
    words, distinct = np.diff(first), np.bincount(row, minlength=n)
    size = np.diff(offsets)

    def share(wanted: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(wanted)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1)

    top = np.zeros(n)
    np.maximum.at(top, row, counts)
    per_word = size / np.maximum(words, 1)
    stats = np.stack(
        [
            np.minimum(4 * share(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))), 2),
            np.minimum(2 * share((data >= 65) & (data <= 90)), 2),
            np.minimum(4 * share((data >= 48) & (data <= 57)), 2),
            np.minimum(10 * share(data == 124), 2),
            np.minimum(4 * share(data == 33), 2),
            distinct / np.maximum(words, 1),
            top / np.maximum(words, 1),
            np.minimum(per_word / 10, 3),
            np.minimum(size / (1 + size * share(data == 10)) / 1000, 3),
            np.log1p(words) / 10,
            (words == 0).astype(float),
        ],
        axis=1,
    )
    base, k = 1 << bits, len(STATISTICS)
    columns = np.concatenate([column, np.tile(base + np.arange(k), n), base + k + np.minimum(np.log2(1 + size) // 2, SIZES - 1).astype(np.int64)])
    weight = np.log1p(counts) / np.sqrt(np.maximum(distinct, 1))[row]
    values = np.concatenate([weight, stats.ravel(), np.full(n, 0.5)])
    rows = np.concatenate([row, np.repeat(np.arange(n), k), np.arange(n)])
    order = np.argsort(rows, kind="stable")
    return columns[order], values[order].astype(np.float32), np.searchsorted(rows[order], np.arange(n + 1))


@dataclass
class Machine:
    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, columns: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        scaled = self.factors[columns] * values[:, None]
        at = first[:-1]  # every row has entries: the statistics
        pairs = np.add.reduceat(scaled, at) ** 2 - np.add.reduceat(scaled**2, at)
        return self.bias + np.add.reduceat(self.linear[columns] * values, at) + pairs.sum(axis=1) / 2


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, seed: int = 7, epochs: int = EPOCHS) -> Machine:
    """Logistic loss, minibatches, per-coordinate step sizes; without both labels a constant score."""
    rng = np.random.default_rng(seed)
    width = width_of(bits)
    model = Machine(bits, 0.0, np.zeros(width, np.float32), rng.normal(0, 0.03, (width, FACTORS)).astype(np.float32))
    share = labels.mean() if len(labels) else 0.5
    model.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not len(labels) or share in (0.0, 1.0):
        model.factors[:] = 0
        return model
    seen_bias, seen, seen_factors = 1e-2, np.full(width, 1e-2, np.float32), np.full((width, FACTORS), 1e-2, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), 64):
            some = order[k : k + 64]
            columns = np.concatenate([rows[i][0] for i in some])
            values = np.concatenate([rows[i][1] for i in some])
            first = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in some])])
            error = 1 / (1 + np.exp(-model.margins(columns, values, first))) - labels[some]
            entry = np.repeat(error, np.diff(first)).astype(np.float32)
            scaled = model.factors[columns] * values[:, None]
            sums = np.repeat(np.add.reduceat(scaled, first[:-1]), np.diff(first), axis=0)
            used, place = np.unique(columns, return_inverse=True)
            slope = np.bincount(place, entry * values, len(used)).astype(np.float32) / len(some) + 1e-5 * model.linear[used]
            slope_factors = np.zeros((len(used), FACTORS), np.float32)
            np.add.at(slope_factors, place, (entry * values)[:, None] * (sums - scaled))
            slope_factors = slope_factors / len(some) + 1e-5 * model.factors[used]
            seen[used] += slope**2
            seen_factors[used] += slope_factors**2
            model.linear[used] -= 0.3 * slope / np.sqrt(seen[used])
            model.factors[used] -= 0.05 * slope_factors / np.sqrt(seen_factors[used])
            seen_bias += error.mean() ** 2
            model.bias -= 0.1 * error.mean() / np.sqrt(seen_bias)
    return model


def learning_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """text, label of at most ``sample`` labelled documents that are not held out, smallest id hash first."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(id_column)).groupBy(id_column)
    known = known.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    chosen = known.orderBy(F.xxhash64(F.col(id_column).cast("string")), id_column).limit(sample)
    texts = docs.where(F.col(id_column).isNotNull()).select(id_column, "text")
    return texts.join(F.broadcast(chosen.select(id_column, "label")), id_column).select("text", "label")


def held_out(id_column: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", bits: int = BITS, sample: int = SAMPLE) -> Machine:
    """Fit on the bounded sample; tasks send back sparse rows, never texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in tb.blocks(batch.column(0)):
                columns, values, first = features(data, offsets, bits)
                cut = [(a, b) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([columns[a:b].astype("<i2").tobytes() for a, b in cut]),
                        pa.array([values[a:b].astype("<f2").tobytes() for a, b in cut]),
                        batch.column(1)[row:stop],
                    ],
                    ["columns", "values", "label"],
                )

    kind = labels.schema["quality"].dataType.simpleString()
    rows = learning_rows(docs, labels, id_column, sample).mapInArrow(run, f"columns binary, values binary, label {kind}")
    # sorted, so that the fit doesn't depend on the order of tasks; repeated documents are cut off last
    gathered = sorted((bytes(r[0]), bytes(r[1]), r[2]) for r in rows.limit(2 * sample).collect())
    sparse = [(np.frombuffer(c, "<i2").astype(np.int64), np.frombuffer(v, "<f2").astype(np.float32)) for c, v, _ in gathered]
    return fit(sparse, np.array([r[2] for r in gathered], dtype=np.float64), bits)


def scores(docs: DataFrame, machine: Machine, id_column: str = "doc_id") -> DataFrame:
    """id, score (0 to 1) of every row; null counts as empty, and an empty text has a score like any other."""
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(machine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = pickle.loads(sent.value)
        for batch in batches:
            for row, stop, data, offsets in tb.blocks(batch.column(1)):
                margin = machine.margins(*features(data, offsets, machine.bits)).astype(np.float64)
                score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[row:stop], pa.array(score)], ["id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), "text").mapInArrow(run, f"id {kind}, score double")
