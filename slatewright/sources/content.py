"""Landed payloads to content rows: story JSON, RSS XML, editorial API JSON, and the common normaliser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.groups import keep_first
from slatewright.schemas import CONTENT_ITEMS

STORY_SCHEMA = "id bigint, type string, title string, url string, by string, time bigint"

EDITORIAL_SCHEMA = (
    "response struct<results: array<struct<id: string, webTitle: string, webUrl: string, "
    "webPublicationDate: string, sectionName: string, "
    "fields: struct<headline: string, trailText: string, byline: string>>>>"
)

RSS_ITEM_SCHEMA = "title string, description string, link string, author string, pubDate string"

# fixed values: the configured feeds (name, category)
FEEDS = [("techcrunch", "tech"), ("ars_technica", "tech"), ("venturebeat", "tech"), ("bbc_world", "world")]


def _fetched(value: str | Column) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def stories(df: DataFrame, fetched_at: str | Column) -> DataFrame:
    """Story objects with a url; epoch seconds become a timestamp."""
    kept = df.where((F.col("type") == "story") & (F.col("url") != ""))
    return kept.select(
        F.concat(F.lit("hn_"), F.col("id").cast("string")).alias("item_id"),
        F.lit("hackernews").alias("source"),
        F.lit("hackernews").alias("source_type"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.lit("").alias("description"),
        "url",
        F.col("by").alias("author"),
        F.when(F.col("time") != 0, F.timestamp_seconds("time")).alias("published_at"),
        _fetched(fetched_at).alias("fetched_at"),
        F.lit("tech").alias("category"),
        F.lit("tech").alias("topic"),
        F.lit("en").alias("language"),
    )


def read_stories(spark: SparkSession, path: str, fetched_at: str) -> DataFrame:
    return stories(spark.read.schema(STORY_SCHEMA).json(path), fetched_at)


def feed_entries(df: DataFrame, feeds: DataFrame, fetched_at: str | Column, first: int | None = None) -> DataFrame:
    """Entries of fetched feed documents (``feed`` name, ``xml`` text of one response), in document order.

    All entries, or the ``first`` so many of each document. Feeds that are not listed have the category unknown.
    """
    items = F.regexp_extract_all("xml", F.lit(r"(?s)<item[\s>].*?</item>"), 0)
    rows = df.select("feed", F.posexplode(items).alias("place", "item"))
    if first is not None:
        rows = rows.where(F.col("place") < first)
    parsed = rows.withColumn("e", F.from_xml("item", RSS_ITEM_SCHEMA, {"rowTag": "item"}))
    text = {n: F.coalesce(F.col(f"e.{n}"), F.lit("")) for n in ("title", "description", "link")}
    stamp = F.regexp_replace("e.pubDate", r"^\s*[A-Za-z]+,\s*", "")
    published = F.coalesce(
        F.try_to_timestamp(stamp, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(stamp, F.lit("d MMM yyyy HH:mm:ss z"))
    )
    named = parsed.join(feeds.select(F.col("name").alias("feed"), F.col("category")), "feed", "left")
    return named.withColumn("category", F.coalesce("category", F.lit("unknown"))).select(
        S.content_hash_id(text["link"], text["title"]).alias("item_id"),
        F.col("feed").alias("source"),
        F.lit("rss").alias("source_type"),
        text["title"].alias("title"),
        text["description"].alias("description"),
        text["link"].alias("url"),
        F.col("e.author").alias("author"),
        published.alias("published_at"),
        _fetched(fetched_at).alias("fetched_at"),
        "category",
        F.col("category").alias("topic"),
        F.lit("en").alias("language"),
        "place",
    )


def read_feeds(
    spark: SparkSession, path: str, fetched_at: str, feeds: DataFrame | None = None, first: int | None = None
) -> DataFrame:
    """Landing layout: ``path/feed=<name>/<response>.xml``."""
    listed = spark.createDataFrame(FEEDS, "name string, category string") if feeds is None else feeds
    raw = spark.read.option("wholetext", True).text(path).select("feed", F.col("value").alias("xml"))
    return feed_entries(raw, listed, fetched_at, first)


def editorial(df: DataFrame, fetched_at: str | Column) -> DataFrame:
    """``response.results`` of search payloads."""
    rows = df.select(F.explode("response.results").alias("r"))
    section = F.coalesce("r.sectionName", F.lit("news"))
    return rows.select(
        F.concat(F.lit("guardian_"), F.replace(F.col("r.id"), F.lit("/"), F.lit("_"))).alias("item_id"),
        F.lit("guardian").alias("source"),
        F.lit("guardian").alias("source_type"),
        F.coalesce("r.fields.headline", "r.webTitle", F.lit("")).alias("title"),
        F.coalesce("r.fields.trailText", F.lit("")).alias("description"),
        F.col("r.webUrl").alias("url"),
        F.col("r.fields.byline").alias("author"),
        S.instant("r.webPublicationDate").alias("published_at"),
        _fetched(fetched_at).alias("fetched_at"),
        section.alias("category"),
        section.alias("topic"),
        F.lit("en").alias("language"),
    )


def read_editorial(spark: SparkSession, path: str, fetched_at: str) -> DataFrame:
    return editorial(spark.read.schema(EDITORIAL_SCHEMA).option("multiLine", True).json(path), fetched_at)


def normalize(df: DataFrame, arrival: str) -> DataFrame:
    """Content rows with all 14 columns, one per url and then one per item_id, first arrival wins.

    Rows without a url count as one url. ``arrival`` orders the batch (unique).
    """
    present = set(df.columns)
    text = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) if n in present else F.lit("") for n in ("title", "description")}
    columns = []
    for field in CONTENT_ITEMS.fields:
        name = field.name
        if name in text:
            value = text[name]
        elif name == "content_length":
            value = F.length(F.concat_ws(" ", text["title"], text["description"]))
        elif name in present:
            value = F.col(name).try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(name))
    rows = df.select(F.col(arrival).alias("_arrival"), *columns)
    by_url = keep_first(rows, ["url"], [F.asc("_arrival")])
    return keep_first(by_url, ["item_id"], [F.asc("_arrival")]).drop("_arrival")


def newest(content: DataFrame, limit: int = 50) -> DataFrame:
    """The ``limit`` newest items that have a title."""
    names = ["item_id", "title", "description", "source", "source_type", "category", "published_at", "url"]
    return (
        content.where(S.not_blank("title"))
        .select(*[n for n in names if n in content.columns])
        .orderBy(F.desc_nulls_last("published_at"), F.asc("item_id"))
        .limit(limit)
    )
