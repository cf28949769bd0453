"""The online snapshot as a keyed, log-structured table.

Entities are hashed into buckets. A batch writes one delta folder, in the buckets it touches only;
the newest row of an entity wins when buckets are read. A bucket with more than ``deltas`` deltas
is compacted into a base of its own. A manifest per version lists the folders of every bucket and is
written last, as one file, so a job lost half-way leaves the version before in force and can simply
run again. Manifests older than ``keep`` versions go, with all that only they refer to.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from slatewright.operators.groups import latest_row

MANIFEST = "version int, bucket int, folder string, user_count bigint, item_count bigint, source_dataset string"
SCHEMA = "entity_type string, entity_id string, payload string, feature_timestamp timestamp, expires_at timestamp"
#: the bucket of the manifest row that has the totals
TOTAL = -1
ENTITY = ["entity_type", "entity_id"]


def newest(rows: DataFrame) -> DataFrame:
    """The newest row per entity; of equal times, the one written last."""
    return latest_row(rows, ENTITY, "feature_timestamp", ["_version", "expires_at", "payload"])


class SnapshotStore:
    """Newest payload per entity under ``path``. One writer at a time; readers see whole versions.

    ``buckets`` is fixed with the first version; a table of 100 TB wants thousands.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, deltas: int = 8, keep: int = 2):
        self.spark, self.path, self.buckets, self.deltas, self.keep = spark, path, buckets, deltas, max(1, keep)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*ENTITY), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/log/*")
        except AnalysisException:  # no version yet
            return None

    def status(self) -> DataFrame | None:
        """version, user_count, item_count, source_dataset of the versions kept; None before the first."""
        rows = self._manifests()
        return None if rows is None else rows.where(F.col("bucket") == TOTAL).drop("bucket", "folder")

    def version(self) -> int | None:
        rows = self.status()
        return None if rows is None else rows.agg(F.max("version").alias("v")).first()["v"]

    def _entries(self, version: int) -> list:
        """Manifest rows of a version: at most buckets times (deltas + 1)."""
        return self._manifests().where((F.col("version") == version) & (F.col("bucket") != TOTAL)).collect()

    def _rows(self, entries: Iterable) -> DataFrame:
        paths = [f"{self.path}/{e['folder']}/bucket={e['bucket']}" for e in entries]
        return self.spark.read.schema(f"{SCHEMA}, _version int").parquet(*paths)

    def read(self, entities: DataFrame | None = None) -> DataFrame | None:
        """The newest rows; with ``entities`` (entity_type, entity_id) only those of their buckets. None before the first version."""
        version = self.version()
        if version is None:
            return None
        entries = self._entries(version)
        if entities is not None:
            wanted = {r[0] for r in entities.select(self._bucket()).distinct().collect()}  # at most as many as buckets
            entries = [e for e in entries if e["bucket"] in wanted]
        if not entries:
            return self.spark.createDataFrame([], SCHEMA)
        return newest(self._rows(entries)).drop("_version")

    def _touched(self, folder: str) -> list[int]:
        try:
            return sorted(r[0] for r in self.spark.read.parquet(f"{self.path}/{folder}").select("bucket").distinct().collect())
        except AnalysisException:  # an empty batch writes no bucket
            return []

    def upsert(self, fresh: DataFrame, source: str = "") -> int:
        """Add a batch as the next version: one delta in the buckets it touches. Older rows than those stored change nothing."""
        last = self.version()
        version = 0 if last is None else last + 1
        live: dict[int, list[str]] = {}
        counts: dict[int, tuple[int, int]] = {}
        for e in [] if last is None else self._entries(last):
            live.setdefault(e["bucket"], []).append(e["folder"])
            counts[e["bucket"]] = (e["user_count"], e["item_count"])
        delta = f"delta={version}"
        rows = fresh.withColumn("_version", F.lit(version)).withColumn("bucket", self._bucket())
        self._written(rows, delta)
        touched = self._touched(delta)
        for b in touched:
            live.setdefault(b, []).append(delta)
        full = [b for b in touched if len(live[b]) > self.deltas]
        if full:
            base = f"base={version}"
            merged = newest(self._rows({"bucket": b, "folder": f} for b in full for f in live[b]))
            self._written(merged.withColumn("bucket", self._bucket()), base)
            live |= {b: [base] for b in full}
        if touched:
            now = newest(self._rows({"bucket": b, "folder": f} for b in touched for f in live[b]))
            kinds = now.groupBy(self._bucket().alias("b")).agg(F.count_if(F.col("entity_type") == "user"), F.count_if(F.col("entity_type") == "item"))
            counts |= {b: (users, items) for b, users, items in kinds.collect()}
        entries = [(version, b, f, *counts[b], source) for b, folders in live.items() for f in folders]
        totals = [sum(c[k] for c in counts.values()) for k in (0, 1)]
        manifest = self.spark.createDataFrame([*entries, (version, TOTAL, "", *totals, source)], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/v={version}")
        self._retire(version)
        return version

    def _written(self, rows: DataFrame, folder: str) -> None:
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")

    def _retire(self, version: int) -> None:
        """Drop manifests beyond ``keep`` and bucket folders that no kept one has."""
        kept = self._manifests().where(F.col("version") > version - self.keep).select("bucket", "folder").distinct()
        old = self._manifests().where(F.col("version") <= version - self.keep)
        gone = old.select("bucket", "folder").distinct().exceptAll(kept).where(F.col("bucket") != TOTAL).collect()
        versions = [r[0] for r in old.select("version").distinct().collect()]
        for path in [*[f"{r['folder']}/bucket={r['bucket']}" for r in gone], *[f"log/v={v}" for v in versions]]:
            self._drop(f"{self.path}/{path}")

    def _drop(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
