"""Online features: the newest snapshot per user and item, with a time to live."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.groups import latest_row
from slatewright.schemas import existing, feature_time

TTL_HOURS = 24

# fixed values: columns a user or item snapshot may carry
USER_COLUMNS = [
    "user_prev_clicks", "user_prev_impressions", "user_ctr_prior", "recent_impression_count", "recent_click_count",
    "recent_save_count", "recent_hide_count", "user_prev_category", "user_prev_source", "user_embedding_norm",
]
ITEM_COLUMNS = [
    "item_prev_impressions", "item_prev_clicks", "item_ctr_prior", "item_age_hours", "source", "source_type",
    "category", "title_length", "description_length", "is_hackernews", "is_rss", "item_embedding_norm",
]
USER_ALIASES = {
    "user_prev_clicks_sim": "user_prev_clicks",
    "user_prev_impressions_sim": "user_prev_impressions",
    "user_ctr_prior_sim": "user_ctr_prior",
    "preferred_category": "user_prev_category",
    "preferred_source": "user_prev_source",
}
ITEM_ALIASES = {
    "item_prev_impressions_sim": "item_prev_impressions",
    "item_prev_clicks_sim": "item_prev_clicks",
    "item_ctr_prior_sim": "item_ctr_prior",
    "age_hours": "item_age_hours",
}
ITEM_EXTRAS = ["hour_published", "weekday_published"]


def _snapshot(df: DataFrame, key: str, columns: list[str], aliases: dict[str, str], tie: list[str]) -> DataFrame:
    """Newest row per key, allowed columns only; an alias also fills its absent target."""
    dated = feature_time(df)
    newest = latest_row(dated.where(F.col(key).isNotNull()), [key], "feature_time", tie)
    kept = existing(df, [*columns, *aliases])
    filled = [
        F.col(alias).alias(target) for alias, target in aliases.items() if alias in df.columns and target not in df.columns
    ]
    return newest.select(key, *kept, *filled, F.col("feature_time").alias("feature_timestamp"))


def user_snapshot(df: DataFrame, tie: list[str]) -> DataFrame:
    return _snapshot(df, "user_id", USER_COLUMNS, USER_ALIASES, tie)


def item_snapshot(df: DataFrame, tie: list[str]) -> DataFrame:
    return _snapshot(df, "item_id", [*ITEM_COLUMNS, *ITEM_EXTRAS], ITEM_ALIASES, tie)


def payloads(snapshot: DataFrame, entity_type: str, written_at: str) -> DataFrame:
    """Key-value form: (entity_type, entity_id, payload JSON with explicit nulls, times)."""
    key = f"{entity_type}_id"
    body = F.struct(*[c for c in snapshot.columns if c != key])
    return snapshot.select(
        F.lit(entity_type).alias("entity_type"),
        F.col(key).cast("string").alias("entity_id"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"),
        "feature_timestamp",
        (F.lit(written_at).cast("timestamp") + F.expr(f"interval {TTL_HOURS} hours")).alias("expires_at"),
    )


def materialize(df: DataFrame, written_at: str, tie: list[str]) -> DataFrame:
    return payloads(user_snapshot(df, tie), "user", written_at).unionByName(
        payloads(item_snapshot(df, tie), "item", written_at)
    )


def status(store: DataFrame, source: str) -> DataFrame:
    return store.agg(
        F.count_if(F.col("entity_type") == "user").alias("user_count"),
        F.count_if(F.col("entity_type") == "item").alias("item_count"),
    ).withColumn("source_dataset", F.lit(source))


def lookup(keys: DataFrame, store: DataFrame, entity_type: str, schema: str, as_of: str) -> DataFrame:
    """Left join of keys (``entity_id``) with unexpired payloads; missing, expired or bad JSON gives nulls."""
    live = store.where(
        (F.col("entity_type") == entity_type) & (F.col("expires_at") > F.lit(as_of).cast("timestamp"))
    ).select("entity_id", F.from_json("payload", schema).alias("features"))
    return keys.join(live, "entity_id", "left")


def overlay(frame: DataFrame, users: DataFrame | None, items: DataFrame | None) -> DataFrame:
    """Online values over a scoring frame: a non-null online value wins; matches and recency follow.

    ``users`` / ``items`` are snapshots keyed by id; None (store down) leaves the frame as it is.
    """
    if users is None and items is None:
        return frame
    for side, key, allowed in ((users, "user_id", USER_COLUMNS), (items, "item_id", ITEM_COLUMNS)):
        if side is None:
            continue
        names = existing(side, allowed)
        frame = frame.join(side.select(key, *[F.col(n).alias(f"_on_{n}") for n in names]), key, "left")
        frame = frame.withColumns(
            {n: F.coalesce(F.col(f"_on_{n}"), F.col(n)) if n in frame.columns else F.col(f"_on_{n}") for n in names}
        ).drop(*[f"_on_{n}" for n in names])
    return refresh_derived(frame)


def refresh_derived(frame: DataFrame) -> DataFrame:
    """Recompute match flags and recency from the current columns."""
    have = set(frame.columns)
    derived = {}
    for what in ("category", "source"):
        if {what, f"user_prev_{what}"} <= have:
            match = S.matches(what, f"user_prev_{what}")
            derived[f"preferred_{what}_match"] = match
            derived[f"user_item_{what}_match_v2"] = match
    if "item_age_hours" in have:
        derived["recency_decay"] = S.recency_decay("item_age_hours")
    return frame.withColumns(derived) if derived else frame
