"""First-generation features: item, user and context features and the labelled training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.groups import latest_row, most_frequent
from slatewright.operators.position import median_time_micros
from slatewright.operators.running import HOT_ROWS, running, trailing
from slatewright.operators.sliding import most_frequent_within

COUNTED_TYPES = {
    "impression": "recent_impression_count",
    "click": "recent_click_count",
    "save": "recent_save_count",
    "hide": "recent_hide_count",
}


def item_features(content: DataFrame, as_of: str) -> DataFrame:
    """Age, text lengths, publishing time and source flags; a missing age takes the median age."""
    now = F.lit(as_of).cast("timestamp")
    # age falls linearly with the publishing time, so the median age follows from the median time
    age = S.hours_between(now, "published_at")
    undated = content.where(F.col("published_at").isNull())
    if not undated.isEmpty():
        median = median_time_micros(content, "published_at")
        age = F.coalesce(age, (F.unix_micros(now) - F.lit(median)) / F.lit(3.6e9))
    text = {c: F.length(F.coalesce(F.col(c), F.lit(""))) if c in content.columns else F.lit(0) for c in ("title", "description")}
    return content.select(
        "item_id",
        S.known("source").alias("source"),
        S.known("source_type").alias("source_type"),
        S.known("category").alias("category"),
        age.alias("age_hours"),
        text["title"].alias("title_length"),
        text["description"].alias("description_length"),
        F.coalesce(F.hour("published_at"), F.lit(-1)).alias("hour_published"),
        F.coalesce(F.weekday("published_at"), F.lit(-1)).alias("weekday_published"),
        F.coalesce(F.col("source_type") == "hackernews", F.lit(False)).cast("int").alias("is_hackernews"),
        F.coalesce(F.col("source_type") == "rss", F.lit(False)).cast("int").alias("is_rss"),
    )


def event_pivot(events: DataFrame) -> DataFrame:
    """Counts of the four event types per user (rows without an item do not count)."""
    return events.groupBy("user_id").agg(
        *[
            F.count(F.when(F.col("event_type") == kind, F.col("item_id"))).alias(name)
            for kind, name in COUNTED_TYPES.items()
        ]
    )


def click_preferences(events: DataFrame, content: DataFrame) -> DataFrame:
    """Most clicked source and category per user with a click on known content."""
    clicks = (
        events.where(F.col("event_type") == "click")
        .select("user_id", "item_id")
        .join(content.select("item_id", "source", "category"), "item_id", "left")
    )
    return most_frequent(clicks, ["user_id"], {"source": "preferred_source", "category": "preferred_category"})


def user_features(events: DataFrame, content: DataFrame) -> DataFrame:
    """All-time counts and preferences per user (no point-in-time cut, as the first generation has it)."""
    joined = event_pivot(events).join(click_preferences(events, content), "user_id", "left")
    return joined.select(
        "user_id",
        *COUNTED_TYPES.values(),
        S.known("preferred_source").alias("preferred_source"),
        S.known("preferred_category").alias("preferred_category"),
    )


def context_columns(ts: Column | str) -> dict[str, Column]:
    t = F.col(ts) if isinstance(ts, str) else ts
    return {"hour_of_day": F.hour(t), "weekday": F.weekday(t), "is_weekend": S.is_weekend(t)}


def context_features(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "impression").select(
        "event_id", *[c.alias(n) for n, c in context_columns("timestamp").items()]
    )


def labelled_impressions(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Impressions with clicked = 1 when the same user clicked the item in the same session."""
    keys = ["user_id", "session_id", "item_id"]
    kept = columns or [
        c
        for c in ("event_id", "timestamp", *keys, "rank_position", "model_version", "policy_name")
        if c in events.columns
    ]
    clicks = events.where(F.col("event_type") == "click").select(*keys).distinct().withColumn("_click", F.lit(1))
    shown = events.where(F.col("event_type") == "impression").select(*kept)
    return shown.join(clicks, keys, "left").select(*kept, F.coalesce("_click", F.lit(0)).alias("clicked"))


def training_dataset(events: DataFrame, content: DataFrame, as_of: str) -> DataFrame:
    """Labelled impressions with item, user and context features.

    Content that several runs fetched counts once (newest row). Context features
    come from the impression's own time, which is what a join on its id returns.
    """
    tie = [c for c in ("url", "title") if c in content.columns]
    unique = latest_row(content, ["item_id"], "fetched_at" if "fetched_at" in content.columns else "published_at", tie)
    labelled = labelled_impressions(events)
    joined = labelled.join(item_features(unique, as_of), "item_id", "left").join(
        user_features(events, unique), "user_id", "left"
    )
    return joined.withColumns(
        {
            **context_columns("timestamp"),
            "preferred_source_match": S.matches("source", "preferred_source"),
            "preferred_category_match": S.matches("category", "preferred_category"),
            **{c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTED_TYPES.values()},
        }
    )


def session_counts(events: DataFrame, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Counts of each event type earlier in the session."""
    return running(
        events,
        ["session_id"],
        order,
        sums={name: (F.col("event_type") == kind).cast("long") for kind, name in COUNTED_TYPES.items()},
        hot_rows=hot_rows,
    )


def session_depth(events: DataFrame, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based place of each event in its session."""
    return running(
        events,
        ["session_id"],
        order,
        sums={"session_depth": F.lit(1).cast("long")},
        inclusive=True,
        hot_rows=hot_rows,
    )


def user_activity_24h(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clicks and impressions of the user in the 24 hours before each event."""
    return trailing(
        events,
        ["user_id"],
        "timestamp",
        86_400,
        {
            "recent_click_count_24h": (F.col("event_type") == "click").cast("int"),
            "recent_impression_count_24h": (F.col("event_type") == "impression").cast("int"),
        },
        hot_rows=hot_rows,
    )


def item_popularity_7d(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clicks on the item in the 7 days before each event."""
    return trailing(
        events,
        ["item_id"],
        "timestamp",
        7 * 86_400,
        {"recent_popularity": (F.col("event_type") == "click").cast("int")},
        hot_rows=hot_rows,
    )


def average_dwell(events: DataFrame, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean dwell time of the user's earlier events (null before the first)."""
    swept = running(
        events,
        ["user_id"],
        order,
        sums={
            "_dwell": F.coalesce(F.col("dwell_time"), F.lit(0.0)),
            "_dwells": F.col("dwell_time").isNotNull().cast("long"),
        },
        hot_rows=hot_rows,
    )
    return swept.withColumn("avg_dwell_time", F.try_divide("_dwell", "_dwells")).drop("_dwell", "_dwells")


def global_ctr(events: DataFrame, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clicks per impression over everything logged before each event."""
    swept = running(
        events,
        [],
        order,
        sums={
            "_clicks": (F.col("event_type") == "click").cast("long"),
            "_shown": (F.col("event_type") == "impression").cast("long"),
        },
        hot_rows=hot_rows,
    )
    return swept.withColumn("global_ctr", S.rate("_clicks", "_shown")).drop("_clicks", "_shown")


def with_preferred_7d(rows: DataFrame, clicks: DataFrame, time: str = "timestamp", ranges: int | None = None) -> DataFrame:
    """Most clicked source and category of the user in the 7 days before each row, to the second."""
    names = {c: f"preferred_{c}_last_7d" for c in ("source", "category")}
    found = most_frequent_within(rows, clicks, ["user_id"], 7 * 86_400, names, time, ranges)
    return found.withColumns({n: S.known(n) for n in names.values()})
