"""Policy scores, propensities and sampled slates on event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.running import HOT_ROWS, softmax
from slatewright.operators.sampling import slate_weight, weighted_sample

POLICY_COLUMNS = {
    "item_ctr": "item_ctr_prior_sim",
    "user_ctr": "user_ctr_prior_sim",
    "recency": "recency_decay_sim",
    "category_match": "preferred_category_match",
    "source_match": "preferred_source_match",
}


def policy_scores(df: DataFrame) -> DataFrame:
    """Logged and target policy score from priors, matches, recency and position (absent ones count 0)."""
    terms = {t: S.number(c) if c in df.columns else F.lit(0.0) for t, c in POLICY_COLUMNS.items()}
    position = S.position_bias("rank_position") if "rank_position" in df.columns else S.position_bias(F.lit(999.0))
    terms["position"] = position
    return df.withColumns(
        {
            "logged_policy_score": S.weighted_sum(S.LOGGED_WEIGHTS, terms),
            "target_policy_score": S.weighted_sum(S.TARGET_WEIGHTS, terms),
        }
    )


def propensity_log(df: DataFrame, spread_by: Sequence[str] = ("event_id",), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Scores of both policies and their session softmax."""
    return softmax(
        policy_scores(df),
        ["session_id"],
        {"logged_propensity": "logged_policy_score", "target_propensity": "target_policy_score"},
        spread_by,
        hot_rows,
    )


def click_terms(df: DataFrame) -> dict:
    """Logit terms for :func:`slatewright.functions.scalars.click_probability` from the usual columns."""
    have = set(df.columns)
    terms = {
        "category": S.matches("category", "preferred_category").cast("double"),
        "source": S.matches("source", "preferred_source").cast("double"),
        "recency": S.recency_decay("age_hours"),
        "position": F.lit(1.0) / F.greatest(S.number("rank_position", 1.0), F.lit(1.0)),
    }
    for term, column, default in (
        ("quality", "quality_score", 0.5),
        ("popularity", "popularity_prior", 0.2),
        ("activity", "activity_level", 0.0),
    ):
        terms[term] = S.number(column, default) if column in have else F.lit(default)
    if "secondary_category" in have:
        terms["secondary"] = S.matches("category", "secondary_category").cast("double")
    return terms


def sampled_slates(candidates: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k items per user drawn by preference, recency and quality weights from its candidate rows."""
    weighted = candidates.withColumn(
        "weight",
        slate_weight(
            S.matches("category", "preferred_category").cast("double"),
            S.matches("source", "preferred_source").cast("double"),
            S.recency_decay(F.coalesce("age_hours", F.lit(24.0))),
            quality=F.lit(0.5),
            popularity=F.lit(0.2),
        ),
    )
    return weighted_sample(weighted, ["user_id"], "weight", ["item_id"], k, seed)
