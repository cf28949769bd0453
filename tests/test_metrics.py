import pytest
from pyspark.sql import functions as F

from slatewright.plans.metrics import (
    binary_metrics,
    counterfactual_report,
    feed_quality_report,
    ranking_report,
    single_policy_report,
)


def session_rows(spark, clicks, session="s1", **columns):
    n = len(clicks)
    rows = [
        (session, f"item_{i}", c, 1.0 - i / 100.0, columns.get("category", ["a"] * n)[i], columns.get("source", ["x"] * n)[i],
         float(columns.get("age_hours", [0.0] * n)[i]))
        for i, c in enumerate(clicks)
    ]
    return spark.createDataFrame(
        rows, "session_id string, event_id string, clicked int, score double, category string, source string, age_hours double"
    )


@pytest.mark.parametrize(
    "clicks,k,precision,recall",
    [([1, 1, 1], 3, 1, 1), ([0, 0, 0], 3, 0, 0), ([1, 0, 0], 3, 1 / 3, 1), ([1, 0, 0, 0, 0], 1, 1, 1), ([1, 0, 1], 2, 0.5, 0.5)],
)
def test_precision_and_recall(spark, clicks, k, precision, recall):
    row = ranking_report(session_rows(spark, clicks), "score", k).first()
    assert row["precision_at_k"] == pytest.approx(precision)
    assert row["recall_at_k"] == pytest.approx(recall)


def test_ndcg(spark):
    good = ranking_report(session_rows(spark, [1, 1, 0, 0]), "score", 4).first()["ndcg_at_k"]
    bad = ranking_report(session_rows(spark, [0, 0, 1, 1]), "score", 4).first()["ndcg_at_k"]
    assert good == pytest.approx(1.0) and 0 <= bad < good
    assert ranking_report(session_rows(spark, [0, 0]), "score", 2).first()["ndcg_at_k"] == 0


def test_sessions_are_averaged_and_empty_input_is_empty(spark):
    both = session_rows(spark, [1, 0], "a").unionByName(session_rows(spark, [0, 0], "b"))
    assert ranking_report(both, "score", 2).first()["precision_at_k"] == pytest.approx(0.25)
    assert ranking_report(both.where("false"), "score", 2).count() == 0


def test_feed_quality(spark):
    same = feed_quality_report(session_rows(spark, [0, 0, 0]), "score", 3).first()
    assert same["category_diversity_at_k"] == pytest.approx(1 / 3)
    assert same["freshness_at_k"] == pytest.approx(1.0)
    mixed = session_rows(spark, [0, 0, 0], category=["a", "b", "c"], source=["x", "y", "z"], age_hours=[100, 100, 100])
    row = feed_quality_report(mixed, "score", 3).first()
    assert row["category_diversity_at_k"] == 1 and row["source_diversity_at_k"] == 1
    assert row["freshness_at_k"] < same["freshness_at_k"]
    assert feed_quality_report(mixed, "score", 1).first()["category_diversity_at_k"] == 1


def test_counterfactual(spark):
    rows = spark.createDataFrame([(1, 0.5, 0.25), (0, 0.25, 0.5), (1, 0.01, 1.0), (None, None, 0.5)], "clicked int, logged_propensity double, target_propensity double")
    row = counterfactual_report(rows.where("clicked is not null")).first()
    w = [0.5, 2.0, 100.0]
    assert row["ips_estimate"] == pytest.approx((w[0] + w[2]) / 3)
    assert row["snips_estimate"] == pytest.approx((w[0] + w[2]) / sum(w))
    assert row["clipped_ips_estimate"] == pytest.approx((0.5 + 10) / 3)
    assert counterfactual_report(rows).first()["n_rows"] == 4


def test_single_policy(spark):
    rows = spark.createDataFrame([(1, 0.4), (0, 0.5), (1, 0.25), (1, 0.6), (0, 0.2)], "r int, p double")
    row = single_policy_report(rows, "r", "p").first()
    total = 1 / 0.4 + 1 / 0.25 + 1 / 0.6
    assert row["ips"] == pytest.approx(total / 5)
    assert row["snips"] == pytest.approx(total / (total + 2 + 5))
    with pytest.raises(Exception, match="propensities"):
        single_policy_report(rows.withColumn("p", F.lit(0.0)), "r", "p").collect()


def test_binary_metrics(spark):
    data = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.2), (0, 0.1)]
    rows = spark.createDataFrame(data, "clicked int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for hot_rows in (10**6, 1):
        row = binary_metrics(rows, "s", hot_rows=hot_rows).first()
        assert row["auc"] == pytest.approx(auc)
        assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(2 / 3)
        assert row["accuracy"] == pytest.approx(5 / 7)
    one = binary_metrics(rows.where("clicked = 0"), "s").first()
    assert one["auc"] is None and one["recall"] == 0
