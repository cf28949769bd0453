"""Second generation: impression backbone, prior features, point-in-time training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.running import HOT_ROWS, asof_join, running
from slatewright.schemas import canonical_names, ensure_columns, existing, require_columns

# fixed values: backbone columns kept only when the input has them
OPTIONAL_COLUMNS = [
    "title_length", "description_length", "hour_published", "weekday_published", "is_hackernews", "is_rss",
    "recent_impression_count", "recent_click_count", "recent_save_count", "recent_hide_count", "preferred_source",
    "preferred_category", "preferred_source_match", "preferred_category_match",
]
RECENT_COLUMNS = ["recent_impression_count", "recent_click_count", "recent_save_count", "recent_hide_count"]

USER_HISTORY = [
    "user_prev_clicks",
    "user_prev_impressions",
    "user_ctr_prior",
    "user_prev_category",
    "user_prev_source",
    *RECENT_COLUMNS,
]
ITEM_HISTORY = ["item_prev_impressions", "item_prev_clicks", "item_ctr_prior"]

# fixed values: null fills of the training rows
NUMERIC_FILL = {
    **{
        name: 0.0
        for name in [
            "user_prev_clicks", "user_prev_impressions", "user_ctr_prior", "recent_impression_count",
            "recent_click_count", "recent_save_count", "recent_hide_count", "item_prev_impressions",
            "item_prev_clicks", "item_ctr_prior", "item_age_hours", "title_length", "description_length",
            "is_hackernews", "is_rss", "preferred_source_match", "preferred_category_match",
        ]
    },
    "rank_position": -1.0,
}
TEXT_FILL = [
    "source", "source_type", "category", "policy_name", "model_version", "user_prev_category", "user_prev_source",
    "preferred_source", "preferred_category",
]


def impression_backbone(
    df: DataFrame, order: Sequence[str] = ("user_id", "item_id", "session_id"), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Cleaned impressions: required ids, 0/1 label, time parts, non-negative age, defaults.

    Without an ``event_id`` rows are numbered 1..n in time order (``order`` breaks ties).
    """
    df = require_columns(canonical_names(df), ["user_id", "item_id", "timestamp", "clicked"])
    rows = df.withColumn("timestamp", S.instant("timestamp")).dropna(
        subset=["user_id", "item_id", "timestamp", "clicked"]
    )
    if "event_id" in df.columns:
        rows = rows.withColumn("impression_id", F.col("event_id").cast("string"))
    else:
        rows = running(
            rows,
            [],
            ["timestamp", *existing(rows, order)],
            sums={"impression_id": F.lit(1).cast("long")},
            inclusive=True,
            hot_rows=hot_rows,
        ).withColumn("impression_id", F.col("impression_id").cast("string"))
    rows = rows.withColumns(
        {
            "impression_time": F.col("timestamp"),
            "clicked": S.label("clicked"),
            "hour": F.hour("timestamp"),
            "day_of_week": F.weekday("timestamp"),
            "is_weekend": S.is_weekend("timestamp"),
            "item_age_hours": S.non_negative(S.number("age_hours")) if "age_hours" in df.columns else F.lit(0.0),
        }
    )
    rows = ensure_columns(
        rows,
        {
            **{n: "unknown" for n in ("source", "source_type", "category", "session_id", "model_version", "policy_name")},
            "rank_position": -1,
        },
    )
    return rows.select(
        "impression_id",
        *existing(df, ["event_id"]),
        "user_id",
        "session_id",
        "item_id",
        "impression_time",
        "clicked",
        "rank_position",
        "model_version",
        "policy_name",
        "source",
        "source_type",
        "category",
        "hour",
        "day_of_week",
        "is_weekend",
        "item_age_hours",
        *existing(df, OPTIONAL_COLUMNS),
    )


def priors(
    df: DataFrame,
    key: str,
    prefix: str,
    time: str,
    tie: Sequence[str],
    suffix: str = "",
    previous: dict | None = None,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Clicks, impressions and click rate of the key before each row."""
    clicks, shown, ctr = (f"{prefix}_{n}{suffix}" for n in ("prev_clicks", "prev_impressions", "ctr_prior"))
    swept = running(
        df,
        [key],
        [time, *tie],
        sums={clicks: F.col("clicked").cast("long"), shown: F.lit(1).cast("long")},
        previous=previous,
        hot_rows=hot_rows,
        counted=counted,
    )
    return swept.withColumn(ctr, S.rate(clicks, shown))


def user_history(df: DataFrame, tie: Sequence[str] = ("impression_id",), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Prior features of the user at each impression; previous category and source come from
    ``preferred_*`` where the input has them, else from the row before."""
    names = {"user_prev_category": "category", "user_prev_source": "source"}
    lagged = {out: F.col(c) for out, c in names.items() if f"preferred_{c}" not in df.columns}
    swept = priors(df, "user_id", "user", "impression_time", tie, previous=lagged, hot_rows=hot_rows)
    given = {out: F.col(f"preferred_{c}") for out, c in names.items() if out not in lagged}
    filled = swept.withColumns(given) if given else swept
    filled = filled.withColumns({out: S.known(out) for out in names})
    filled = ensure_columns(filled, {c: F.lit(0).cast("long") for c in RECENT_COLUMNS})
    return filled.select("user_id", F.col("impression_time").alias("feature_timestamp"), *USER_HISTORY, *tie)


def item_history(df: DataFrame, tie: Sequence[str] = ("impression_id",), hot_rows: int = HOT_ROWS) -> DataFrame:
    swept = priors(df, "item_id", "item", "impression_time", tie, hot_rows=hot_rows)
    extra = existing(
        df, ["item_age_hours", "source", "category", "title_length", "description_length", "is_hackernews", "is_rss"]
    )
    return swept.select("item_id", F.col("impression_time").alias("feature_timestamp"), *ITEM_HISTORY, *extra, *tie)


def point_in_time(
    impressions: DataFrame,
    users: DataFrame,
    items: DataFrame,
    tie: Sequence[str] = ("impression_id",),
    strict: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Training rows: the newest user and item features known at each impression, fills, matches, recency."""
    with_user = asof_join(
        impressions,
        users,
        "user_id",
        "impression_time",
        "feature_timestamp",
        existing(users, USER_HISTORY),
        "user_feature_time",
        existing(users, tie),
        strict,
        hot_rows,
        counted=impressions,
    )
    joined = asof_join(
        with_user,
        items,
        "item_id",
        "impression_time",
        "feature_timestamp",
        existing(items, ITEM_HISTORY),
        "item_feature_time",
        existing(items, tie),
        strict,
        hot_rows,
        counted=impressions,
    )
    have = set(joined.columns)
    filled = joined.withColumns(
        {
            **{n: S.number(n, v) for n, v in NUMERIC_FILL.items() if n in have},
            **{n: S.known(n) for n in TEXT_FILL if n in have},
        }
    )
    derived = {
        f"user_item_{what}_match_v2": (
            S.matches(what, f"user_prev_{what}") if {what, f"user_prev_{what}"} <= have else F.lit(0)
        )
        for what in ("category", "source")
    }
    derived["recency_decay"] = S.recency_decay("item_age_hours") if "item_age_hours" in have else F.lit(1.0)
    return filled.withColumns(derived)


def training_rows(
    impressions: DataFrame, tie: Sequence[str] = ("impression_id",), strict: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    return point_in_time(
        impressions,
        user_history(impressions, tie, hot_rows),
        item_history(impressions, tie, hot_rows),
        tie,
        strict,
        hot_rows,
    )


def event_priors(events: DataFrame, tie: Sequence[str] = ("event_id",), hot_rows: int = HOT_ROWS) -> DataFrame:
    """User and item priors and recency on an event log (``timestamp``, ``clicked``, ``age_hours``)."""
    by_user = priors(events, "user_id", "user", "timestamp", tie, "_sim", hot_rows=hot_rows)
    by_item = priors(by_user, "item_id", "item", "timestamp", tie, "_sim", hot_rows=hot_rows, counted=events)
    return by_item.withColumn("recency_decay_sim", S.recency_decay("age_hours"))


def temporal_validity(rows: DataFrame) -> DataFrame:
    """One row of checks on training rows: no future features, no negative age, label counts."""
    have = set(rows.columns)

    def violations(side: str):
        name = f"{side}_feature_time"
        return F.count_if(F.col(name) > F.col("impression_time")) if name in have else F.lit(None).cast("long")

    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        violations("user").alias("future_user_features"),
        violations("item").alias("future_item_features"),
        (F.count_if(F.col("item_age_hours") < 0) if "item_age_hours" in have else F.lit(None).cast("long")).alias(
            "negative_ages"
        ),
        F.count_if(F.col("clicked") == 1).alias("clicked_rows"),
        F.count_if(F.col("clicked") == 0).alias("not_clicked_rows"),
    )
