"""Table checks and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)


def content_report(content: DataFrame) -> DataFrame:
    """One row: total, blank urls and titles, urls that occur more than once.

    Rows merge per url first, so all four numbers need a single exchange.
    """
    per_url = content.groupBy("url").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(S.blank("title")).alias("_bad_titles")
    )
    zero = F.lit(0).cast("long")
    return per_url.agg(
        F.coalesce(F.sum("_n"), zero).alias("total_rows"),
        F.coalesce(F.sum(F.when(S.blank("url"), F.col("_n"))), zero).alias("bad_urls"),
        F.count_if(F.col("_n") > 1).alias("duplicate_url_groups"),
        F.coalesce(F.sum("_bad_titles"), zero).alias("bad_titles"),
    )


def newest_events(events: DataFrame, limit: int = 20) -> DataFrame:
    names = ["timestamp", "user_id", "session_id", "event_type", "item_id", "rank_position", "event_id"]
    return (
        events.select(*[n for n in names if n in events.columns])
        .orderBy(F.desc_nulls_last("timestamp"), F.desc("event_id"))
        .limit(limit)
    )


def null_counts(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Nulls per column, most first, in one pass over the frame; all columns, or the ``limit`` first."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    tall = counted.select(F.explode(pairs).alias("_p")).select("_p.*")
    ordered = tall.orderBy(F.desc("nulls"), F.asc("column_name"))
    return ordered if limit is None else ordered.limit(limit)


def value_counts(df: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """The most frequent values (null included) of each column: (column_name, value, n).

    All columns are counted in one pass; each keeps its ``limit`` best by rank filter.
    """
    from slatewright.operators.groups import top_k

    tall = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("_p")
    ).select("_p.*")
    counts = tall.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, ["column_name"], [F.desc("n"), F.asc_nulls_first("value")], limit, "_r").drop("_r")


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns and distinct items, users and sessions."""
    distinct = [
        F.count_distinct(c).alias(f"unique_{c.removesuffix('_id')}s")
        for c in ("item_id", "user_id", "session_id")
        if c in df.columns
    ]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), *distinct)


def candidates_per_user(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("user_id").agg(F.count("item_id").alias("candidates"))
