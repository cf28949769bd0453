"""Ranking, feed-quality, counterfactual and binary metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.groups import top_k
from slatewright.operators.running import HOT_ROWS, running

RANKING = ["precision_at_k", "recall_at_k", "ndcg_at_k"]
FEED_QUALITY = ["category_diversity_at_k", "source_diversity_at_k", "freshness_at_k"]


def session_ranking(df: DataFrame, score: str, k: int = 5, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """precision, recall and NDCG at k per session.

    Labels are 0/1, so the ideal DCG depends only on the number of clicks and
    needs no second sort.
    """
    place = F.col("_rank")
    ranked = top_k(df, ["session_id"], [F.desc_nulls_last(score), *[F.asc(t) for t in tie]], k, "_rank")
    top = ranked.groupBy("session_id").agg(
        F.sum("clicked").alias("_hits"), F.sum(F.col("clicked") / F.log2(place + F.lit(1.0))).alias("_dcg")
    )
    totals = df.groupBy("session_id").agg(F.sum("clicked").alias("_clicks"))
    ideal = [sum(1.0 / _log2(i + 2) for i in range(n)) for n in range(k + 1)]
    best = F.get(F.array(*[F.lit(x) for x in ideal]), F.least(F.col("_clicks"), F.lit(k)).cast("int"))
    zero = F.lit(0.0)
    return totals.join(top, "session_id").select(
        "session_id",
        (F.col("_hits") / F.lit(float(k))).alias("precision_at_k"),
        F.when(F.col("_clicks") > 0, F.col("_hits") / F.col("_clicks")).otherwise(zero).alias("recall_at_k"),
        F.when(F.col("_clicks") > 0, F.col("_dcg") / best).otherwise(zero).alias("ndcg_at_k"),
    )


def _log2(x: float) -> float:
    import math

    return math.log2(x)


def session_feed_quality(df: DataFrame, score: str, k: int = 5, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Distinct categories and sources per shown row and mean recency in the top k of each session."""
    age = next((c for c in ("age_hours", "item_age_hours") if c in df.columns), None)
    ranked = top_k(df, ["session_id"], [F.desc_nulls_last(score), *[F.asc(t) for t in tie]], k, "_rank")
    n = F.count(F.lit(1))
    return ranked.groupBy("session_id").agg(
        # at most k values per session
        (F.size(F.collect_set("category")) / n).alias("category_diversity_at_k"),
        (F.size(F.collect_set("source")) / n).alias("source_diversity_at_k"),
        F.avg(S.recency_decay(age) if age else F.lit(1.0)).alias("freshness_at_k"),
    )


def _macro(sessions: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean over sessions; no session gives no row."""
    report = sessions.agg(F.count(F.lit(1)).alias("sessions"), *[F.avg(n).alias(n) for n in names])
    return report.where(F.col("sessions") > 0)


def ranking_report(df: DataFrame, score: str, k: int = 5, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    return _macro(session_ranking(df, score, k, tie), RANKING)


def feed_quality_report(df: DataFrame, score: str, k: int = 5, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    return _macro(session_feed_quality(df, score, k, tie), FEED_QUALITY)


def policy_delta(
    df: DataFrame,
    k: int = 5,
    logged: str = "logged_policy_score",
    target: str = "target_policy_score",
    tie: Sequence[str] = ("event_id",),
) -> DataFrame:
    """(metric, logged, target, delta) for ranking and feed-quality metrics of two policies."""

    def tall(score: str, name: str) -> DataFrame:
        both = []
        for report, names in ((ranking_report, RANKING), (feed_quality_report, FEED_QUALITY)):
            row = report(df, score, k, tie)
            pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias(name)) for n in names])
            both.append(row.select(F.explode(pairs).alias("_p")).select("_p.*"))
        return both[0].unionByName(both[1])

    joined = tall(logged, "logged").join(tall(target, "target"), "metric")
    return joined.select("metric", "logged", "target", (F.col("target") - F.col("logged")).alias("delta"))


def counterfactual_report(
    df: DataFrame,
    reward: str = "clicked",
    logged: str = "logged_propensity",
    target: str = "target_propensity",
    clip: float = 10.0,
) -> DataFrame:
    """IPS, SNIPS, clipped IPS and means in one pass."""
    prepared = df.select(
        S.number(reward).alias("_r"), S.number(logged, 1e-12).alias("_l"), S.number(target, 1e-12).alias("_t")
    )
    weighted = prepared.withColumn("_w", F.col("_t") / F.greatest("_l", F.lit(1e-12)))
    r, w = F.col("_r"), F.col("_w")
    clipped = F.least(F.greatest(w, F.lit(0.0)), F.lit(float(clip)))
    return weighted.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(r).alias("observed_ctr"),
        F.avg(w * r).alias("ips_estimate"),
        F.coalesce(F.try_divide(F.sum(w * r), F.sum(w)), F.lit(0.0)).alias("snips_estimate"),
        F.avg(clipped * r).alias("clipped_ips_estimate"),
        F.avg("_l").alias("mean_logged_propensity"),
        F.avg("_t").alias("mean_target_propensity"),
    )


def single_policy_report(df: DataFrame, reward: str, propensity: str) -> DataFrame:
    """IPS and SNIPS from rewards and propensities of one policy; a propensity <= 0 raises."""
    p = F.when(
        F.col(propensity) <= 0, F.raise_error(F.lit("all propensities must be > 0")).cast("double")
    ).otherwise(F.col(propensity))
    return df.select(F.col(reward).cast("double").alias("_r"), (F.lit(1.0) / p).alias("_w")).agg(
        F.avg(F.col("_r") * F.col("_w")).alias("ips"),
        (F.sum(F.col("_r") * F.col("_w")) / F.sum("_w")).alias("snips"),
    )


def binary_metrics(
    df: DataFrame, score: str, label: str = "clicked", threshold: float = 0.5, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """AUC (null with one class), accuracy, precision and recall at the threshold.

    Equal scores merge first; negatives below each score come from a running sum
    over ranges of scores, so no task orders a large frame. Areas are whole numbers.
    """
    counts = df.groupBy(F.col(score).alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.sum(1 - F.col(label).cast("long")).alias("_neg")
    )
    swept = running(counts, [], ["_score"], sums={"_below": F.col("_neg")}, hot_rows=hot_rows)
    over = F.col("_score") >= F.lit(threshold)
    return (
        swept.agg(
            F.sum("_pos").alias("_p"),
            F.sum("_neg").alias("_n"),
            F.sum(F.col("_pos").cast("decimal(19,0)") * (2 * F.col("_below") + F.col("_neg"))).alias("_area"),
            F.coalesce(F.sum(F.when(over, F.col("_pos"))), F.lit(0)).alias("_tp"),
            F.coalesce(F.sum(F.when(over, F.col("_neg"))), F.lit(0)).alias("_fp"),
        )
        .where(F.col("_p").isNotNull())
        .select(
            (F.col("_p") + F.col("_n")).alias("n_rows"),
            F.try_divide(F.col("_area").cast("double"), F.lit(2.0) * F.col("_p") * F.col("_n")).alias("auc"),
            ((F.col("_tp") + F.col("_n") - F.col("_fp")) / (F.col("_p") + F.col("_n"))).alias("accuracy"),
            S.rate("_tp", F.col("_tp") + F.col("_fp")).alias("precision"),
            S.rate("_tp", F.col("_p")).alias("recall"),
        )
    )
