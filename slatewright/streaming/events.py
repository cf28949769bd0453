"""Event jobs as streams: ingest with deduplication, windowed counts, click attribution, snapshot upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatewright.plans.features import COUNTED_TYPES
from slatewright.sources import online
from slatewright.sources.snapshots import SnapshotStore
from slatewright.sources.tables import with_event_defaults


def read_events(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Files landing in a folder; the schema needs ``timestamp`` as TIMESTAMP."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event_id once, as long as its copies arrive within the watermark."""
    return events.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["event_id"])


def ingest(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Deduplicated events in the event-table schema with the log's defaults."""
    return with_event_defaults(deduplicated(events, late))


def activity(events: DataFrame, width: str = "1 hour", late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts of each event type per user and window; a window is emitted once it is closed."""
    window = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    counts = (
        events.withWatermark("timestamp", late)
        .groupBy(window.alias("w"), "user_id")
        .agg(
            *[
                F.count(F.when(F.col("event_type") == kind, F.col("item_id"))).alias(name)
                for kind, name in COUNTED_TYPES.items()
            ]
        )
    )
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", *COUNTED_TYPES.values()
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events per user session, a session ending after ``gap`` without events."""
    return (
        events.withWatermark("timestamp", late)
        .groupBy(F.session_window("timestamp", gap).alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "user_id", "events")
    )


def attributed(events: DataFrame, within: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Impressions with ``clicked``: the same user, session and item clicked within the bound after it.

    Several clicks on one impression repeat it; keep one row per event_id downstream
    with :func:`one_per_impression`.
    """
    base = events.withWatermark("timestamp", late)
    shown = base.where(F.col("event_type") == "impression")
    clicks = base.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("_u"), F.col("session_id").alias("_s"), F.col("item_id").alias("_i"), F.col("timestamp").alias("_ct")
    )
    on = (
        (F.col("user_id") == F.col("_u"))
        & (F.col("session_id") == F.col("_s"))
        & (F.col("item_id") == F.col("_i"))
        & (F.col("_ct") >= F.col("timestamp"))
        & (F.col("_ct") <= F.col("timestamp") + F.expr(f"interval {within}"))
    )
    joined = shown.join(clicks, on, "leftOuter")
    return joined.withColumn("clicked", F.col("_ct").isNotNull().cast("int")).drop("_u", "_s", "_i", "_ct")


def one_per_impression(rows: DataFrame) -> DataFrame:
    names = [c for c in rows.columns if c not in ("event_id", "clicked")]
    return rows.groupBy("event_id").agg(*[F.first(c).alias(c) for c in names], F.max("clicked").alias("clicked"))


def keep_snapshot(rows: DataFrame, path: str, checkpoint: str, tie: list[str], available_now: bool = True):
    """Upsert the newest user and item features of every micro-batch into the snapshot store, in the buckets it touches."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        written = batch.agg(F.max("timestamp").cast("string").alias("t")).first()["t"]
        SnapshotStore(batch.sparkSession, path).upsert(online.materialize(batch, written, tie), f"batch {batch_id}")

    writer = rows.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_stream(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
