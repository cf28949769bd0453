"""Stage files and tables: Parquet, JSON reports, create, append, SQL, event append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatewright.schemas import CONTENT_ITEMS, EVENT_DEFAULTS, EVENTS, conform, ensure_columns

TABLES = {"content_items": CONTENT_ITEMS, "events": EVENTS}


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_stage(
    spark: SparkSession, path: str, times: Sequence[str] = (), schema: T.StructType | None = None
) -> DataFrame:
    """Read a stage file (a missing one raises) and coerce its time columns, bad values to null."""
    df = read_parquet(spark, path, schema)
    found = {t: F.col(t).try_cast("timestamp") for t in times if t in df.columns}
    return df.withColumns(found) if found else df


def write_report(df: DataFrame, path: str) -> None:
    """A small report (metrics, checks) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def archive_raw(df: DataFrame, path: str, run: str) -> None:
    """Raw payloads of one run, e.g. run '20240102_030405'."""
    df.write.mode("errorifexists").json(f"{path}/run={run}")


def create_tables(spark: SparkSession, database: str | None = None) -> None:
    prefix = f"{database}." if database else ""
    for name, schema in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({schema.toDDL()}) USING parquet")


def append(df: DataFrame, name: str, database: str | None = None) -> None:
    """Append by column name: absent columns become null, extra ones are left out."""
    target = f"{database}.{name}" if database else name
    conform(df, TABLES[name]).write.insertInto(target)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL; frames given by keyword are usable in it as ``{name}``."""
    return spark.sql(sql, **frames)


def with_event_defaults(df: DataFrame) -> DataFrame:
    """Event rows as the log stores them: absent columns and null payload fields get the defaults."""
    filled = ensure_columns(df, {"event_id": F.lit(None).cast("string"), **EVENT_DEFAULTS})
    return conform(
        filled.withColumns(
            {
                "event_id": F.coalesce(F.col("event_id").cast("string"), F.uuid()),
                **{name: F.coalesce(name, F.lit(value)) for name, value in EVENT_DEFAULTS.items()},
            }
        ),
        EVENTS,
    )
