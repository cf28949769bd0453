"""Ranked feeds for all users in one batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.functions import vectors as V
from slatewright.operators.groups import latest_row
from slatewright.operators.rerank import rerank_v1, rerank_v2
from slatewright.operators.retrieval import HEAD_ITEMS, retrieve, retrieve_each
from slatewright.plans.features import COUNTED_TYPES, context_columns
from slatewright.plans.fills import UsualFill
from slatewright.schemas import existing
from slatewright.session import written
from slatewright.sources import online
from slatewright.sources.content import newest

Scorer = PipelineModel | Callable[[DataFrame], Column] | None

# fixed values: inputs of the second-generation ranker
NUMERIC_FEATURES = [
    "rank_position", "hour", "day_of_week", "is_weekend", "item_age_hours", "title_length", "description_length",
    "hour_published", "weekday_published", "is_hackernews", "is_rss", "recent_impression_count", "recent_click_count",
    "recent_save_count", "recent_hide_count", "user_prev_clicks", "user_prev_impressions", "user_ctr_prior",
    "item_prev_impressions", "item_prev_clicks", "item_ctr_prior", "preferred_source_match",
    "preferred_category_match", "user_item_category_match_v2", "user_item_source_match_v2", "recency_decay",
    "user_item_embedding_cosine", "user_embedding_norm", "item_embedding_norm",
]
RETRIEVAL_FEATURES = ["blended_retrieval_score", "retrieval_score_raw", "retrieval_strategy_count"]
CATEGORICAL_FEATURES = [
    "source", "source_type", "category", "policy_name", "model_version", "user_prev_category", "user_prev_source",
    "embedding_affinity_bucket",
]

MAX_LIMIT = 50


def check_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return limit


def with_user_defaults(rows: DataFrame, user_features: DataFrame) -> DataFrame:
    """User features on every row; an unknown user has no history and no preference."""
    joined = rows.join(user_features, "user_id", "left")
    return joined.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTED_TYPES.values()},
            "preferred_source": S.known("preferred_source"),
            "preferred_category": S.known("preferred_category"),
        }
    )


def scoring_frame(
    users: DataFrame, content: DataFrame, item_features: DataFrame, user_features: DataFrame, as_of: str, pool: int = 50
) -> DataFrame:
    """The ``pool`` newest titled items for every user with item, user and request-time features.

    The pool is one list of fixed length, so it reaches the users as a value and
    nothing is shuffled but the users themselves.
    """
    items = newest(content, pool)
    features = [c for c in item_features.columns if c == "item_id" or c not in items.columns]
    enriched = items.join(item_features.select(*features), "item_id", "left")
    listed = enriched.agg(F.collect_list(F.struct(*enriched.columns)).alias("l")).scalar()
    now = F.lit(as_of).cast("timestamp")
    rows = with_user_defaults(users, user_features).withColumn("_i", F.explode(listed))
    flat = rows.select(*[c for c in rows.columns if c != "_i"], "_i.*")
    return flat.withColumns(
        {
            **context_columns(now),
            "preferred_source_match": S.matches("source", "preferred_source"),
            "preferred_category_match": S.matches("category", "preferred_category"),
        }
    )


def score(frame: DataFrame, scorer: Scorer, score_as: str = "model_score") -> DataFrame:
    """Apply a fitted pipeline or a column expression; None means the heuristic."""
    if scorer is None:
        return frame.withColumn(score_as, S.heuristic_score(frame.columns))
    if isinstance(scorer, PipelineModel):
        kept = frame.columns
        scored = scorer.transform(frame)
        return scored.select(*kept, vector_to_array("probability")[1].alias(score_as))
    return frame.withColumn(score_as, scorer(frame))


def rank_feed_v1(
    users: DataFrame,
    content: DataFrame,
    item_features: DataFrame,
    user_features: DataFrame,
    as_of: str,
    scorer: Scorer,
    limit: int = 10,
    model_version: str = "lightgbm",
) -> DataFrame:
    """First-generation feed: newest items, scored, fresh and diverse; one row per served item."""
    frame = scoring_frame(users.select("user_id"), content, item_features, user_features, as_of)
    ranked = rerank_v1(score(frame, scorer), ["user_id"], limit, bounded=True)
    return _with_requests(ranked, users).select(
        "user_id",
        "session_id",
        F.lit(model_version).alias("model_version"),
        "item_id",
        "title",
        "source",
        "source_type",
        "category",
        "url",
        F.col("published_at").cast("string").alias("published_at"),
        "model_score",
        "freshness_bonus",
        "final_rank",
    )


def _with_requests(ranked: DataFrame, users: DataFrame) -> DataFrame:
    if "session_id" in users.columns:
        return ranked.join(users.select("user_id", "session_id"), "user_id")
    return ranked.withColumn("session_id", F.lit(None).cast("string"))


def item_side(training: DataFrame, tie: list[str], online_items: DataFrame | None = None) -> DataFrame:
    """Newest training row per item (all columns, packed) with the item's online values beside it."""
    packed = latest_row(training, ["item_id"], "impression_time", tie).select(
        "item_id", F.struct(*[c for c in training.columns if c not in ("user_id", "item_id")]).alias("row")
    )
    if online_items is None:
        return packed
    names = existing(online_items, online.ITEM_COLUMNS)
    return packed.join(online_items.select("item_id", F.struct(*names).alias("online")), "item_id", "full")


def feature_frame(candidates: DataFrame, training: DataFrame, tie: list[str]) -> DataFrame:
    """One scoring row per candidate.

    Columns come from the item's newest training row, else from the user's newest
    row, else (unknown user) from the newest row of all; a candidate's own source
    and category win. ``candidates`` carry the item row in the struct ``item``.
    """
    columns = [c for c in training.columns if c not in ("user_id", "item_id")]
    newest_user = latest_row(training, ["user_id"], "impression_time", tie).select(
        "user_id", F.struct(*columns).alias("_user")
    )
    place = F.struct("impression_time", *tie)
    newest_any = training.agg(F.max_by(F.struct(*columns), place).alias("r")).scalar()
    joined = candidates.join(newest_user, "user_id", "left")
    fallback = F.coalesce(F.col("_user"), newest_any)
    rows = joined.withColumn("_row", F.coalesce(F.col("item.row"), fallback))
    own = {"source", "category"} & set(columns)
    return rows.select(
        "user_id",
        *existing(candidates, ["limit"]),
        "item_id",
        *[F.coalesce(F.col(c), F.col(f"_row.{c}")).alias(c) if c in own else F.col(f"_row.{c}").alias(c) for c in columns],
        *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in RETRIEVAL_FEATURES],
        *(["item"] if "item" in candidates.columns else []),
    )


def serving_columns(frame: DataFrame) -> DataFrame:
    """Derive the serving-time columns a frame does not have yet."""
    have = set(frame.columns)
    made = {}
    for what in ("category", "source"):
        left = F.col(what) if what in have else F.lit("unknown")
        right = F.col(f"user_prev_{what}") if f"user_prev_{what}" in have else F.lit("unknown")
        for name in (f"preferred_{what}_match", f"user_item_{what}_match_v2"):
            if name not in have:
                made[name] = S.matches(left, right)
    if "recency_decay" not in have:
        made["recency_decay"] = S.recency_decay("item_age_hours") if "item_age_hours" in have else F.lit(1.0)
    if "embedding_affinity_bucket" not in have:
        cos = S.number("user_item_embedding_cosine") if "user_item_embedding_cosine" in have else F.lit(0.0)
        made["embedding_affinity_bucket"] = V.affinity_bucket(cos)
    return frame.withColumns(made) if made else frame


def score_v2(frame: DataFrame, scorer: Scorer = None) -> DataFrame:
    """Coerced features, then the model if it can run on them, else the heuristic."""
    numeric = existing(frame, [*NUMERIC_FEATURES, *RETRIEVAL_FEATURES])
    text = existing(frame, CATEGORICAL_FEATURES)
    coerced = frame.withColumns({**{c: S.number(c) for c in numeric}, **{c: S.known(c) for c in text}})
    if isinstance(scorer, PipelineModel) and not usable(scorer, coerced):
        scorer = None
    return score(coerced, scorer)


def usable(model: PipelineModel, frame: DataFrame) -> bool:
    """Whether the frame has every column the model reads."""
    made: set[str] = set()
    for stage in model.stages:
        wanted = set()
        for param in ("inputCol", "inputCols", "featuresCol", "numeric", "categorical"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                wanted |= {value} if isinstance(value, str) else set(value)
        if not wanted <= made | set(frame.columns):
            return False
        if isinstance(stage, UsualFill):
            made.update(*stage.outputs())
        for param in ("outputCol", "outputCols"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                made |= {value} if isinstance(value, str) else set(value)
    return True


def rank_feed_v2(
    impressions: DataFrame,
    training: DataFrame,
    users: DataFrame | None = None,
    limit: int = 10,
    scorer: Scorer = None,
    online_users: DataFrame | None = None,
    online_items: DataFrame | None = None,
    tie: tuple[str, ...] = ("impression_id",),
    head: int = HEAD_ITEMS,
) -> DataFrame:
    """Second-generation feed: retrieve, build features, overlay online values, score, rerank.

    The retrieval lists hold ids and scores; item features join the blended candidates, by
    broadcast where the items are few, and everything after that is partitioned by user.
    """
    check_limit(limit)
    tie = list(tie)
    items = written(item_side(training, tie, online_items), "item_rows")
    candidates = retrieve(
        impressions, users, max(10, 2 * limit), max(20, 3 * limit), head=head, item_columns=items
    )
    return _ranked(candidates, training, ["user_id"], limit, F.lit(limit), scorer, online_users, online_items, tie)


def _ranked(
    candidates: DataFrame,
    training: DataFrame,
    slate: list[str],
    most: int,
    limit: Column,
    scorer: Scorer,
    online_users: DataFrame | None,
    online_items: DataFrame | None,
    tie: list[str],
) -> DataFrame:
    """Features, online values, scores and diversity for every slate of candidates, and its first ``limit`` rows (``most`` at most)."""
    frame = feature_frame(candidates, training, tie)
    frame = serving_columns(frame)
    if online_items is not None:
        names = existing(online_items, online.ITEM_COLUMNS)
        frame = frame.withColumns(
            {
                n: F.coalesce(F.col(f"item.online.{n}"), F.col(n)) if n in frame.columns else F.col(f"item.online.{n}")
                for n in names
            }
        )
    frame = frame.drop("item")
    if online_users is not None:
        frame = online.overlay(frame, online_users, None)
    elif online_items is not None:
        frame = online.refresh_derived(frame)
    # the slate is at most 3 * limit rows, so counting it is a small window
    frame = frame.withColumn("candidate_count", F.count(F.lit(1)).over(W.partitionBy(*slate)).cast("int"))
    scored = score_v2(frame, scorer).select(
        *slate,
        "item_id",
        "source",
        "category",
        "blended_retrieval_score",
        "recency_decay",
        "model_score",
        "candidate_count",
    )
    # picks don't depend on how many follow, so a shorter feed is the beginning of a longer one
    return rerank_v2(scored, slate, most, bounded=True).where(F.col("rank") <= limit).select(
        *slate,
        "candidate_count",
        F.least(F.col("candidate_count"), limit).alias("returned_count"),
        "item_id",
        "source",
        "category",
        "blended_retrieval_score",
        "model_score",
        "final_score",
        "rank",
    )


def _sorted_out(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with a limit that can be served and the others, each with its ``status``."""
    fits = F.coalesce(F.col("limit").between(1, MAX_LIMIT), F.lit(False))
    marked = requests.withColumn("status", F.when(fits, "ok").otherwise("invalid limit"))
    return marked.where(fits), marked.where(~fits)


def serve_v1(feed: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (user_id, session_id, limit) answered from a first-generation feed built for the
    largest limit: the pool does not depend on the limit, so a shorter feed is its beginning.
    A request with an invalid limit is one row with that ``status`` and no item."""
    valid, invalid = _sorted_out(requests)
    rows = valid.join(feed.drop("session_id"), "user_id").where(F.col("final_rank") <= F.col("limit"))
    return rows.unionByName(invalid, allowMissingColumns=True)


def serve_v2(
    impressions: DataFrame,
    training: DataFrame,
    requests: DataFrame,
    scorer: Scorer = None,
    online_users: DataFrame | None = None,
    online_items: DataFrame | None = None,
    tie: tuple[str, ...] = ("impression_id",),
    head: int = HEAD_ITEMS,
) -> DataFrame:
    """Requests (user_id, session_id, limit) answered by the second-generation feed, all in one plan.

    The candidate pool depends on the limit, which goes as a column through list cuts, blend and
    slate. Requests of one user and limit share a feed. A request with an invalid limit is one row
    with that ``status`` and no item.
    """
    valid, invalid = _sorted_out(requests)
    limit = F.col("limit")
    items = written(item_side(training, list(tie), online_items), "item_rows")
    candidates = retrieve_each(
        impressions, valid, F.greatest(F.lit(10), 2 * limit), F.greatest(F.lit(20), 3 * limit), 2 * MAX_LIMIT, head, items
    )
    feed = _ranked(candidates, training, ["user_id", "limit"], MAX_LIMIT, limit, scorer, online_users, online_items, list(tie))
    served = valid.select("user_id", "session_id", "limit", "status").join(feed, ["user_id", "limit"])
    return served.unionByName(invalid, allowMissingColumns=True)
