"""Whitening against numpy's eigensolver and Python's whole numbers."""

import math

import numpy as np
import pytest

from slatewright.llm import whitening
from slatewright.llm.queries import QUERIES, prepared

SCHEMA = "vec_id bigint, embedding array<double>, n int, component string, id int"


def plain(rows, scale=1024, offset=100_000, most=8):
    """(vec_id, x, deviation) of the rows that count, covariance, eigenvalues and eigenvectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    length = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    x = [(i, [math.floor(scale * c) + offset for c in v]) for i, v in good if len(v) == length]
    n, sums = len(x), [sum(c) for c in zip(*(v for _, v in x))]
    out = [(i, v, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for _, v in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    return out, centred, v, values[::-1][:most], vectors[:, ::-1][:, :most]


def compare(got, rows):
    out, centred, v, values, vectors = plain(rows)
    rank = np.linalg.matrix_rank(v, hermitian=True)
    values, vectors = values[:rank], vectors[:, :rank]
    assert len(got) == len(out) * len(values)
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    want = centred @ vectors / np.sqrt(values)
    for k in range(len(values)):
        mine = np.array([by_key[i, k + 1][0].whitened for i, _, _ in out])
        sign = np.sign(mine @ want[:, k])
        assert mine * sign == pytest.approx(want[:, k], abs=1e-6)
    for i, _, deviation in out:
        for k, e in enumerate(values):
            for r in by_key[i, k + 1]:
                assert r.n == len(out) and r.deviation == deviation
                assert r.explained == pytest.approx(e / np.trace(v), rel=1e-9)
                assert r.identity_error < 1e-9


def run(spark, rows, components=8):
    df = spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SCHEMA).repartition(3)
    return whitening.whitened(df, whitening.fitted(df, components)).withColumnRenamed("id", "vec_id").collect()


def test_query(spark, folder):
    got = QUERIES["op13_whitening"](spark, folder)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    compare(got.collect(), rows)


def test_awkward_rows(spark):
    prepared(spark)
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(40, 5)) * [3, 2, 1, 1e-2, 0])]
    rows += [(0, rows[0][1])] * 3 + [(50, None), (51, []), (52, [1.0, None, 0.0, 0.0, 0.0]), (53, [float("nan")] * 5), (54, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (55, [1.0, 2.0])]
    rows += [(None, [9.0, 9.0, 9.0, 0.0, 0.0])]
    compare(run(spark, rows), rows)


def test_large_entries_stay_exact(spark):
    prepared(spark)
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.integers(-(10**9), 10**9, size=(30, 3)))]
    compare(run(spark, rows), rows)


def test_nothing_to_whiten(spark):
    prepared(spark)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == []
    assert run(spark, [(1, [1.0, 2.0])] * 4) == []
