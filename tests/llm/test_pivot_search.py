"""Largest inner products against all products."""

import math

import numpy as np
import pytest

from slatewright.llm import pivot_search
from slatewright.llm.queries import QUERIES, prepared

SCHEMA = "vec_id bigint, embedding array<double>, score int, rank string, block int"


def plain(rows, k=20, every=20, scale=64):
    good = [(i, tuple(v)) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    length = min(set(sizes), key=lambda s: (-sizes.count(s), s)) if good else 0
    points = sorted({(i, tuple(math.floor(scale * c) for c in v)) for i, v in good if len(v) == length})
    out = []
    for i, q in points:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in points if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, **kwargs):
    prepared(spark)
    df = spark.createDataFrame([(i, v, 1, "r", 2) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in pivot_search.nearest(df, **kwargs).collect())


def clustered(n, d, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    x = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, d)) * 0.1
    return [(k, [float(c) for c in v]) for k, v in enumerate(x)]


def test_query(spark, folder):
    got = QUERIES["op12_nearest"](spark, folder)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_awkward_rows(spark):
    rows = clustered(150, 5, 1)
    rows += [rows[0]] * 3 + [(40, rows[7][1]), (-20, [0.0] * 5)] + [(k, [1.0, 0.5, 0.0, 0.0, 0.0]) for k in range(200, 245)]
    rows += [(60, None), (80, []), (100, [1.0, None, 0.0, 0.0, 0.0]), (120, [float("nan")] * 5), (None, [1.0] * 5), (160, [float("-inf"), 1.0, 1.0, 1.0, 1.0]), (180, [1.0])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, k=3, every=7, scale=10) == plain(rows, 3, 7, 10)


def test_many_blocks(spark, monkeypatch):
    """Several blocks for a cell, cells of two pivots, several groups of ranges."""
    for name, value in (("BLOCK", 8), ("QUERY_BLOCK", 3), ("RANGES", 4)):
        monkeypatch.setattr(pivot_search, name, value)
    rows = clustered(400, 6, 2)
    assert run(spark, rows, k=5, every=4, pivots=4) == plain(rows, 5, 4)


def test_few_candidates_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(20, None)]) == []
    assert run(spark, [(20, [1.0, 2.0])]) == []
    some = [(20, [1.0, 2.0]), (21, [0.0, 0.0]), (40, [-1.0, 3.0])]
    assert run(spark, some) == plain(some)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.integers(-(2**24), 2**24, size=(60, 4)))]
    assert run(spark, rows, every=5) == plain(rows, every=5)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [1e12]), (1, [1e12])])


def test_bounds_leave_candidates_out():
    """On clustered vectors a query looks at few candidates before it stops."""
    rows = clustered(3000, 8, 3, 30)
    x = np.floor(np.array([v for _, v in rows]) * 64)
    space = pivot_search.Space(8, 64, float(np.abs(x).max()), float((x * x).sum(axis=1).max()), x[:0])
    space.pivots = pivot_search.spread_out(x[:500], space.square, 16)
    ids = np.arange(len(x), dtype=np.int64)

    def block(rows, d):
        return pivot_search.Block(space, {"ids": ids[rows].tobytes(), "x": x[rows].astype(space.kind).tobytes(), "d": d.astype(np.float32).tobytes()})

    asked = ids % 20 == 0
    queries, points = block(asked, space.queries(x[asked])[0]), block(slice(None), space.candidates(x))
    found = list(pivot_search.best_of(space, queries, points, 20, np.full(int(asked.sum()), -np.inf)))
    assert sum(n for *_, n in found) < 0.3 * asked.sum() * len(x)
    for place, near, scores, _ in found:
        q = queries.ids[place]
        want = sorted((-int(x[q] @ x[j]), int(j)) for j in ids if j != q)[:20]
        assert [(-int(s), int(j)) for s, j in zip(scores, near)] == want
