"""Table schemas and the optional-column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# fixed values: column names and types of the tables and feeds
CONTENT_ITEMS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("full_text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("content_length", T.IntegerType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("rank_position", T.IntegerType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("policy_name", T.StringType()),
        T.StructField("propensity", T.DoubleType()),
        T.StructField("dwell_time", T.DoubleType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("metadata", T.StringType()),
    ]
)

# values an event row takes when the producer leaves them out
EVENT_DEFAULTS = {
    "model_version": "v0_manual",
    "policy_name": "manual_feed",
    "device_type": "desktop",
    "metadata": "{}",
}

FEED_V1 = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("model_score", T.DoubleType()),
        T.StructField("freshness_bonus", T.DoubleType()),
        T.StructField("final_rank", T.IntegerType()),
    ]
)

FEED_V2 = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("candidate_count", T.IntegerType()),
        T.StructField("returned_count", T.IntegerType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("blended_retrieval_score", T.DoubleType()),
        T.StructField("model_score", T.DoubleType()),
        T.StructField("final_score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


def canonical_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each absent column with its default (a value or a Column)."""
    added = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(added) if added else df


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*existing(df, names))


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a schema: absent columns become null, present ones are leniently cast."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def feature_time(df: DataFrame) -> DataFrame:
    """Add ``feature_time`` from ``impression_time``, else ``timestamp``, else fail."""
    for name in ("impression_time", "timestamp"):
        if name in df.columns:
            return df.withColumn("feature_time", F.col(name).try_cast("timestamp"))
    raise ValueError("expected an impression_time or timestamp column")
