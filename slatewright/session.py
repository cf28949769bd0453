"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# settings only a new session takes: capturing the call site of every column
# expression costs more than building the plans
BUILDER_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else built."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch one only where unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read to the shared folder and read it back.

    Cuts the lineage: the steps after it neither plan nor recompute what is before
    it, and a lost executor costs a re-read. Unlike a checkpoint it stays columnar.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """The same, dealt into buckets by a column, so that a join on it need not shuffle the frame again.

    The catalog knows the table only while it is written and opened.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = fresh_folder(spark, name)
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(table, format="parquet")
    rows = spark.table(table)
    rows.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {table}")
    return rows
