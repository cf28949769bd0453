"""Exact selection by position without a global sort.

The row at a given position of a total order is found level by level: count rows
per coarse bucket, pick the bucket the position falls in, then look only inside
that bucket with the next finer level. Every level has a bounded number of
buckets, and the last one is a hash of the row id, so equal values divide as
well. The tie order among equal values is therefore (hash, id).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatewright.session import written


def id_hash(ids: Sequence[str], seed: str = "") -> Column:
    return F.md5(F.concat_ws("|", *([F.lit(seed)] if seed else []), *[F.col(c).cast("string") for c in ids]))


def time_levels(time: str) -> dict[str, Column]:
    """Day, second of the day, microsecond: together the exact time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return {
        "_day": F.floor(micros / F.lit(86_400_000_000)).cast("long"),
        "_sec": F.floor(F.pmod(micros, F.lit(86_400_000_000)) / F.lit(1_000_000)).cast("long"),
        "_mic": F.pmod(micros, F.lit(1_000_000)).cast("long"),
    }


def day_level(time: str) -> dict[str, Column]:
    """For columns that hold whole days."""
    return {"_day": F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(86_400_000_000)).cast("long")}


def hash_levels(hash_column: str) -> dict[str, Column]:
    return {"_h1": F.substring(hash_column, 1, 4), "_h2": F.substring(hash_column, 5, 4)}


def _descend(
    frame: DataFrame, levels: Sequence[str], targets: DataFrame, within: Sequence[str], weight: str
) -> DataFrame:
    """Bucket of every level and the position left, for targets per group (lazy in the groups).

    Each level is written out: the next one reads it twice.
    """
    found, done = targets, []
    for level in levels:
        join_on = [*within, *done]
        inside = frame.join(found.select(*join_on).distinct(), join_on, "left_semi") if done else frame
        counts = inside.groupBy(*join_on, level).agg(F.sum(weight).alias("_n"))
        upto = W.partitionBy(*join_on).orderBy(level).rowsBetween(W.unboundedPreceding, 0)
        cumulative = counts.withColumn("_upto", F.sum("_n").over(upto))
        hit = (F.col("position") < F.col("_upto")) & (F.col("position") >= F.col("_upto") - F.col("_n"))
        found = written(
            found.join(cumulative, join_on)
            .where(hit)
            .select(*join_on, level, "target", (F.col("position") - F.col("_upto") + F.col("_n")).alias("position")),
            "level",
        )
        done = [*done, level]
    return found


def _descend_whole(frame: DataFrame, levels: Sequence[str], targets: dict[str, int], weight: str) -> dict[str, tuple]:
    """The same for a few targets over the whole frame: {target: (level values, position left)}.

    The driver sees one row per target and level; the buckets found so far become
    literal filters, which reach the scan.
    """
    found = {target: ((), position) for target, position in targets.items()}
    for i, level in enumerate(levels):
        prefixes = {values for values, _ in found.values()}
        inside = frame
        if i:
            tests = [_all_equal(levels[:i], values) for values in prefixes]
            inside = frame.where(_any(tests))
        counts = inside.groupBy(*levels[: i + 1]).agg(F.sum(weight).alias("_n"))
        if i == 0:
            counts = counts.withColumn("_one", F.lit(0))
        by = levels[:i] or ["_one"]
        cumulative = counts.withColumn(
            "_upto", F.sum("_n").over(W.partitionBy(*by).orderBy(level).rowsBetween(W.unboundedPreceding, 0))
        )
        tests = []
        for values, position in found.values():
            here = (F.col("_upto") > position) & (F.col("_upto") - F.col("_n") <= position)
            tests.append(here & _all_equal(levels[:i], values) if i else here)
        rows = cumulative.where(_any(tests)).collect()  # one row per target
        step = {}
        for target, (values, position) in found.items():
            for row in rows:
                start = row["_upto"] - row["_n"]
                if tuple(row[n] for n in levels[:i]) == values and start <= position < row["_upto"]:
                    step[target] = ((*values, row[level]), position - start)
        found = step
    return found


def _all_equal(names: Sequence[str], values: Sequence) -> Column:
    test = F.lit(True)
    for name, value in zip(names, values):
        test = test & (F.col(name) == F.lit(value))
    return test


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def _leveled(df: DataFrame, levels: Mapping[str, Column], extra: Sequence[str], weight: Column | None = None) -> DataFrame:
    return df.select(
        *extra, *[c.alias(n) for n, c in levels.items()], (F.lit(1) if weight is None else weight).cast("long").alias("_w")
    )


def split_by_time(
    df: DataFrame,
    time: str,
    ids: Sequence[str],
    train: float = 0.70,
    validate: float = 0.85,
    levels: Mapping[str, Column] | None = None,
    split_as: str = "split",
) -> DataFrame:
    """Chronological train/val/test by row position int(n*train), int(n*validate)."""
    hashed = df.withColumn("_hash", id_hash(ids))
    steps = {**(levels or time_levels(time)), **hash_levels("_hash")}
    names, rest = list(steps), ["_hash", *ids]
    n = df.count()
    if n == 0:
        return df.withColumn(split_as, F.lit(None).cast("string"))
    targets = {"train": int(n * train), "val": int(n * validate)}
    frame = _leveled(hashed, steps, rest)
    key = F.struct(*[c.alias(c_name) for c_name, c in steps.items()], *rest)
    edges = {}
    for target, (values, position) in _descend_whole(frame, names, targets, "_w").items():
        bucket = frame.where(_all_equal(names, values))
        row = bucket.orderBy(*rest).limit(position + 1).orderBy(*[F.desc(c) for c in rest]).first()
        edges[target] = F.struct(
            *[F.lit(v).cast(frame.schema[c].dataType).alias(c) for c, v in zip(names, values)],
            *[F.lit(row[c]).cast(frame.schema[c].dataType).alias(c) for c in rest],
        )
    place = F.when(key < edges["train"], "train").when(key < edges["val"], "val").otherwise("test")
    return hashed.withColumn(split_as, place).drop("_hash")


def split_stratified(
    df: DataFrame, stratum: str, ids: Sequence[str], share: float = 0.7, seed: int = 42, split_as: str = "split"
) -> DataFrame:
    """Seeded random split keeping the share of every label: the first
    floor(share * n) rows of each label in the order of a seeded hash train."""
    hashed = df.withColumn("_hash", id_hash(ids, str(seed)))
    steps = hash_levels("_hash")
    names, rest = list(steps), ["_hash", *ids]
    frame = _leveled(hashed, steps, [stratum, *rest])
    targets = frame.groupBy(stratum).agg(
        F.lit("cut").alias("target"), F.floor(F.count(F.lit(1)) * F.lit(share)).cast("long").alias("position")
    )
    found = _descend(frame, names, targets, [stratum], "_w")
    bucket = [stratum, *names]
    inside = frame.join(found.select(*bucket), bucket, "left_semi")
    placed = inside.withColumn("_rn", F.row_number().over(W.partitionBy(*bucket).orderBy(*rest)) - 1)
    edges = written(
        found.join(placed, bucket)
        .where(F.col("_rn") == F.col("position"))
        .select(stratum, F.struct(*names, *rest).alias("edge")),
        "edges",
    )
    key = F.struct(*[c.alias(n) for n, c in steps.items()], *rest)
    return (
        hashed.join(edges, stratum, "left")
        .withColumn(split_as, F.when(key < F.col("edge"), "train").otherwise("test"))
        .drop("_hash", "edge")
    )


def median_within(df: DataFrame, within: Sequence[str], value: str, median_as: str = "median") -> DataFrame:
    """Exact median of a double per group. Equal values merge first; a group is never
    gathered: whole part, then 1/65536 steps, then the distinct values of one step."""
    keys = list(within)
    distinct = written(
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")), "values"
    )
    whole = F.floor(value)
    levels = {
        "_whole": whole.cast("long"),
        "_step": F.floor((F.col(value) - whole) * 65536).cast("long"),
        "_value": F.col(value),
    }
    ends = [
        F.struct(F.lit(name).alias("target"), F.floor((F.col("_n") - less) / 2).cast("long").alias("position"))
        for name, less in (("low", 1), ("high", 0))
    ]
    sizes = distinct.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    targets = sizes.select(*keys, F.explode(F.array(*ends)).alias("_t")).select(*keys, "_t.target", "_t.position")
    found = _descend(_leveled(distinct, levels, keys, F.col("_n")), list(levels), targets, keys, "_w")
    return found.groupBy(*keys).agg(F.avg("_value").alias(median_as))


def median_time_micros(df: DataFrame, time: str) -> float | None:
    """Exact median of a timestamp in microseconds, nulls skipped; None when all are null."""
    steps = time_levels(time)
    present = df.where(F.col(time).isNotNull())
    n = present.count()
    if n == 0:
        return None
    targets = {"low": (n - 1) // 2, "high": n // 2}
    found = _descend_whole(_leveled(present, steps, []), list(steps), targets, "_w")
    micros = [d * 86_400_000_000 + s * 1_000_000 + m for (d, s, m), _ in found.values()]
    return sum(micros) / 2
