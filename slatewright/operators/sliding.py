"""The most frequent value within a trailing window, to the second.

Every event leaves two marks, one where its value enters the window and one where it leaves it. Marks
and rows are dealt by ranges of (key, second) and written, so a key that owns a third of the log is
in many ranges. A range begins with a carry: the counts its key has from the ranges before it. One
sweep over a range keeps the counts and a heap of them, which answers every row; a sweep holds the
values one key has in one window, never its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.operators.running import spread_of
from slatewright.session import written

_CARRY, _MARK, _ROW = -1, 0, 1


class Counts:
    """Counts of values and the most frequent one, the smallest of equally frequent ones."""

    def __init__(self) -> None:
        self.counts: dict[str, int] = {}
        self.heap: list[tuple[int, str]] = []

    def add(self, value: str, n: int) -> None:
        total = self.counts.get(value, 0) + n
        if total:
            self.counts[value] = total
            heapq.heappush(self.heap, (-total, value))
        else:
            self.counts.pop(value, None)
        if len(self.heap) > 64 + 4 * len(self.counts):  # entries of counts that have changed since
            self.heap = [(-m, v) for v, m in self.counts.items()]
            heapq.heapify(self.heap)

    def best(self) -> str | None:
        while self.heap and self.counts.get(self.heap[0][1]) != -self.heap[0][0]:
            heapq.heappop(self.heap)
        return self.heap[0][1] if self.heap else None


def most_frequent_within(
    rows: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    seconds: int,
    values: Mapping[str, str],
    time: str = "timestamp",
    ranges: int | None = None,
) -> DataFrame:
    """``rows`` with the most frequent value of each column among the key's events in [t - seconds, t - 1s].

    ``values`` maps columns of ``events`` to output names; the smallest of equally frequent values
    counts, null values don't. A row without events in its window, or without a time, gets nulls; rows
    with a null key are a group of their own. Repeated rows and events all count.
    """
    names = list(values)
    key = F.to_json(F.struct(*keys)).alias("_k")
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    pairs = F.array(*[F.struct(F.lit(i).alias("_col"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(names)])
    tall = events.where(F.col(time).isNotNull()).select(key, second.alias("_at"), F.explode(pairs).alias("_p"))
    # events of one key, second and value merge before the exchange
    merged = tall.where(F.col("_p._value").isNotNull()).groupBy("_k", "_at", "_p").agg(F.count(F.lit(1)).alias("_n"))
    ends = F.explode(F.array(*[F.struct((F.col("_at") + 1 + late).alias("_sec"), F.lit(sign).alias("_sign")) for late, sign in ((0, 1), (seconds, -1))]))
    marks = merged.select("_k", "_p.*", "_n", ends.alias("_e")).select(
        "_k", F.col("_e._sec").alias("_sec"), F.lit(_MARK).alias("_kind"), "_col", "_value", (F.col("_n") * F.col("_e._sign")).alias("_n")
    )
    probes = rows.where(F.col(time).isNotNull()).select(
        key, second.alias("_sec"), F.lit(_ROW).alias("_kind"), spread_of(rows, rows.columns).alias("_spread"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    )
    parts = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stacked = marks.unionByName(probes, allowMissingColumns=True)
    dealt = stacked.repartitionByRange(parts, "_k", "_sec", "_kind", "_spread", "_col", "_value").withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "window-marks")

    # what each range of a key begins with; only keys in several ranges have any
    spans = dealt.select("_k", "_range").distinct()
    spans = spans.join(spans.groupBy("_k").agg(F.count("*").alias("_m")).where("_m > 1").select("_k"), "_k", "left_semi")
    sums = dealt.where(F.col("_kind") == _MARK).groupBy("_k", "_range", "_col", "_value").agg(F.sum("_n").alias("_n")).where("_n <> 0")
    later = spans.alias("s").join(sums.alias("c"), (F.col("s._k") == F.col("c._k")) & (F.col("c._range") < F.col("s._range")))
    carry = later.groupBy(F.col("s._k").alias("_k"), F.col("s._range").alias("_range"), "_col", "_value").agg(F.sum("_n").alias("_n"))
    carry = carry.where("_n <> 0").select("_k", F.lit(-(2**62)).alias("_sec"), F.lit(_CARRY).alias("_kind"), "_col", "_value", "_n", "_range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, []
        for batch in batches:
            of, kinds, columns, found, n = (batch.column(c).to_pylist() for c in ("_g", "_kind", "_col", "_value", "_n"))
            at, out = [], [[] for _ in names]
            for k, own in enumerate(of):
                if own != group:
                    group, state = own, [Counts() for _ in names]
                if kinds[k] == _ROW:
                    at.append(k)
                    for held, counts in zip(out, state):
                        held.append(counts.best())
                else:
                    state[columns[k]].add(found[k], n[k])
            if at:
                yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(at)), *(pa.array(x, pa.string()) for x in out)], ["_row", *values.values()])

    swept = dealt.unionByName(carry, allowMissingColumns=True)
    swept = swept.withColumn("_g", F.concat(F.col("_range").cast("string"), F.lit(" "), "_k")).repartition(parts, "_range")
    swept = swept.sortWithinPartitions("_g", "_sec", "_kind").select("_g", "_kind", "_col", "_value", "_n", "_row")
    kind = probes.schema["_row"].dataType.simpleString()
    answered = swept.mapInArrow(run, f"_row {kind}, " + ", ".join(f"`{v}` string" for v in values.values()))
    timeless = rows.where(F.col(time).isNull()).withColumns({v: F.lit(None).cast("string") for v in values.values()})
    return answered.select("_row.*", *[f"`{v}`" for v in values.values()]).unionByName(timeless)
