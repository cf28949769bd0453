"""Greedy reranking: the reference cases and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from slatewright.operators import rerank
from slatewright.operators.rerank import greedy_rerank, prune, rerank_v1, rerank_v2, with_freshness

SCHEMA = "slate int, item_id int, score double, category string, source string"


def slates(n_slates, n, categories, sources, seed):
    rng = random.Random(seed)
    return [
        (s, i, round(rng.random(), 2), rng.choice(categories), rng.choice(sources)) for s in range(n_slates) for i in range(n)
    ]


def greedy(rows, k, wc, ws):
    left, picked = sorted(rows, key=lambda r: (-r[2], r[1])), []
    while left and len(picked) < k:
        def adjusted(r):
            cp = sum(p[3] == r[3] for p in picked) * wc
            sp = sum(p[4] == r[4] for p in picked) * ws
            return r[2] - cp - sp
        best = max(left, key=adjusted)
        picked.append(best)
        left.remove(best)
    return [p[1] for p in picked]


@pytest.mark.parametrize("shape", [(20, 12, "abc", "xy"), (6, 60, "abcdefgh", "stuvwxyz"), (4, 200, "a", "xyz")])
def test_greedy_equals_brute_force_with_and_without_pruning(spark, shape, monkeypatch):
    monkeypatch.setattr(rerank, "LARGE_SLATE", 50)
    n, m, cats, srcs = shape
    rows = slates(n, m, cats, srcs, 11)
    frame = spark.createDataFrame(rows, SCHEMA)
    for bounded in (True, False):
        out = greedy_rerank(frame, ["slate"], "score", 4, 0.08, 0.10, bounded=bounded).collect()
        for s in range(n):
            got = [r["item_id"] for r in sorted((r for r in out if r["slate"] == s), key=lambda r: r["final_rank"])]
            assert got == greedy([r for r in rows if r[0] == s], 4, 0.08, 0.10)


def test_pruning_bounds_a_slate(spark, monkeypatch):
    monkeypatch.setattr(rerank, "LARGE_SLATE", 100)
    rows = [(0, i, (i * 37 % 1000) / 1000.0, f"c{i % 50}", f"s{i % 41}") for i in range(4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    k = 3
    assert prune(frame, ["slate"], "score", "item_id", k).count() <= (2 * k * (k - 1) + 1) * k
    got = [r["item_id"] for r in greedy_rerank(frame, ["slate"], "score", k).orderBy("final_rank").collect()]
    assert got == greedy(rows, k, 0.08, 0.10)


@pytest.mark.parametrize("large", [5_000, 2])
def test_rows_without_a_score_come_last_and_once(spark, monkeypatch, large):
    monkeypatch.setattr(rerank, "LARGE_SLATE", large)
    bad, inf = float("nan"), float("inf")
    rows = [(0, 1, 0.9, "c", "s"), (0, 2, bad, "c", "s"), (0, 3, None, "d", "t"), (0, 4, 0.5, "d", "t"), (0, 5, -inf, "e", "u")]
    rows += [(1, 1, None, "c", "s"), (1, 2, bad, "c", "s"), (1, 3, inf, "c", "s")]
    for bounded in (True, False):
        out = greedy_rerank(spark.createDataFrame(rows, SCHEMA), ["slate"], "score", 5, bounded=bounded)
        got = {s: [(r["item_id"], r["final_score"]) for r in out.where(f"slate = {s}").orderBy("final_rank").collect()] for s in (0, 1)}
        assert got[0] == [(1, 0.9), (4, 0.5), (5, -inf), (2, None), (3, None)]
        assert got[1] == [(3, inf), (1, None), (2, None)]


def test_second_rerank_counts_a_bad_base_as_zero(spark):
    rows = [("s", 1, -0.2, "c", "x"), ("s", 2, float("nan"), "d", "y"), ("s", 3, None, "e", "z"), ("s", 4, 0.3, "f", "w")]
    frame = spark.createDataFrame(rows, "slate string, item_id int, model_score double, category string, source string")
    got = rerank_v2(frame, ["slate"], 4).orderBy("rank").collect()
    assert [(r["item_id"], r["final_score"]) for r in got] == [(4, 0.3), (2, 0.0), (3, 0.0), (1, -0.2)]


def test_count_and_ranks(spark):
    frame = spark.createDataFrame(slates(1, 10, "ab", "xy", 1), SCHEMA)
    assert greedy_rerank(frame, ["slate"], "score", 5).count() == 5
    assert greedy_rerank(frame.where("item_id < 5"), ["slate"], "score", 20).count() == 5
    same = frame.withColumn("category", F.lit("tech"))
    ranks = [r["final_rank"] for r in greedy_rerank(same, ["slate"], "score", 5).orderBy("final_rank").collect()]
    assert ranks == [1, 2, 3, 4, 5]
    assert greedy_rerank(frame.where("false"), ["slate"], "score", 5).count() == 0


@pytest.mark.parametrize("large", [5000, 1])
def test_freshness_bonus(spark, monkeypatch, large):
    monkeypatch.setattr(rerank, "LARGE_SLATE", large)
    frame = spark.createDataFrame([(1, 0.0), (1, 24.0), (1, 200.0), (1, None), (2, 1.0), (2, 100.0)], "slate int, age_hours double")
    got = [(r["slate"], r["age_hours"], r["freshness_bonus"]) for r in with_freshness(frame, ["slate"]).collect()]
    assert len(got) == 6
    by = {(s, a): b for s, a, b in got}
    assert by[(1, 0.0)] == pytest.approx(0.15)
    assert by[(1, None)] == pytest.approx(0.15 * math.exp(-1))
    assert by[(2, 1.0)] > by[(2, 100.0)]
    assert all(b >= 0 for b in by.values())


def test_apply_reranking_columns(spark):
    frame = spark.createDataFrame(slates(1, 6, "ab", "xy", 2), SCHEMA).withColumns(
        {"model_score": F.col("score"), "age_hours": F.col("item_id").cast("double"), "recency_decay": F.lit(0.5)}
    )
    v1 = rerank_v1(frame, ["slate"], 3)
    assert {"final_rank", "freshness_bonus", "preliminary_score", "final_score"} <= set(v1.columns)
    assert [r["final_rank"] for r in v1.orderBy("final_rank").collect()] == [1, 2, 3]
    # every item is returned when the limit allows it
    assert rerank_v2(frame, ["slate"], 10).count() == 6
