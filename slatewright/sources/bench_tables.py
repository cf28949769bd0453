"""The given tables read as the feed's own tables.

events -> event log, part -> content of the events, lineitem/orders/part -> a
scored impression log with sessions, pages -> fetched content, embeddings -> item
vectors. Times become TIMESTAMP (streaming and epoch functions need it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.running import running

# fixed values: how the given event types read as feed events
EVENT_TYPE_NAMES = {"view": "impression", "click": "click", "purchase": "save", "error": "hide", "signup": "feed_request"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str, types: list[str] | None = None) -> DataFrame:
    """The event log; ``types`` filters on the stored names so that it reaches the scan."""
    raw = table(spark, folder, "events")
    if types is not None:
        raw = raw.where(F.col("event_type").isin([given for given, name in EVENT_TYPE_NAMES.items() if name in types]))
    return as_events(raw)


def as_events(raw: DataFrame) -> DataFrame:
    week = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 7).cast("int").cast("string")
    kind = F.col("event_type")
    mapped = None
    for given, name in EVENT_TYPE_NAMES.items():
        mapped = F.when(kind == given, name) if mapped is None else mapped.when(kind == given, name)
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("_"), week).alias("session_id"),
        mapped.alias("event_type"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        F.col("value").alias("dwell_time"),
        F.col("props").alias("metadata"),
    )


def content(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_brand").alias("source"),
        F.when(F.col("p_size") % 2 == 0, "rss").otherwise("hackernews").alias("source_type"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("/items/"), F.col("p_partkey").cast("string")).alias("url"),
        (
            F.lit("2023-12-01 00:00:00").cast("timestamp")
            + F.make_dt_interval(hours=(F.col("p_partkey") % 1000).cast("int"))
        ).alias("published_at"),
    )


def impressions(spark: SparkSession, folder: str) -> DataFrame:
    """Impression and click events as impression rows with the click as label."""
    shown = events(spark, folder, ["impression", "click"])
    items = content(spark, folder).drop("title", "url")
    joined = shown.join(items, "item_id", "left")
    placed = running(
        joined,
        ["session_id"],
        ["timestamp", "event_id"],
        sums={"rank_position": F.lit(1).cast("long")},
        inclusive=True,
        counted=shown,
    )
    return placed.select(
        "event_id",
        F.col("timestamp").alias("impression_time"),
        "user_id",
        "session_id",
        "item_id",
        (F.col("event_type") == "click").cast("int").alias("clicked"),
        F.col("rank_position").cast("int").alias("rank_position"),
        "source",
        "source_type",
        "category",
        S.hours_between("timestamp", "published_at").alias("age_hours"),
        "dwell_time",
    )


def scored_log(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as scored impressions: one order is a session, one line a slate entry."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    shipped, ordered = F.col("l_shipdate").cast("timestamp"), F.col("o_orderdate").cast("timestamp")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), cents.cast("string")).alias("event_id"),
        F.col("l_orderkey").alias("session_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_linenumber").alias("rank_position"),
        (F.col("l_returnflag") == "R").cast("int").alias("clicked"),
        shipped.alias("impression_time"),
        F.col("p_brand").alias("source"),
        F.col("p_type").alias("category"),
        S.hours_between(shipped, ordered).alias("raw_age_hours"),
        S.non_negative(S.hours_between(shipped, ordered)).alias("age_hours"),
        F.col("l_extendedprice").alias("score"),
    )


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as fetched records, twice: the second batch repeats every url with a new title."""
    pages = table(spark, folder, "pages")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    first = pages.select(
        F.lit(1).alias("batch"),
        "page_id",
        "url",
        title.alias("title"),
    )
    again = first.select(F.lit(2).alias("batch"), "page_id", "url", F.concat("title", F.lit(" (v2)")).alias("title"))
    both = first.unionByName(again)
    return both.select(
        ((F.col("batch") - 1) * 1_000_000_000_000 + F.col("page_id")).alias("arrival"),
        S.content_hash_id("url", "title").alias("item_id"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("source"),
        F.lit("rss").alias("source_type"),
        "title",
        "url",
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("page_id").cast("int"))).alias(
            "published_at"
        ),
        F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1).alias("category"),
    )


def item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("item_id"), F.col("embedding").cast("array<double>").alias("item_vector")
    )


VECTOR_DIMS = 64
