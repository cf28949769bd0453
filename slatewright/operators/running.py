"""Running (prefix) aggregates, as-of joins and trailing-window sums.

A plain window partitioned by user or item puts a whole key into one task, so a
key that owns a third of the log stalls the job. Here the rows of keys above
``hot_rows`` go through a distributed prefix scan: they are dealt by ranges of the
full order (key, time, tie) and written, each range is windowed alone, and receives
the carry of the ranges of its key before it, which comes from one small aggregate
per key and range. As ranges follow the whole order, rows of one key and one time
are spread like any others. Without such keys the plan is the plain window: one
exchange.

Hot keys are counted first, in a job that reads the key columns only. The counts
are exact, so re-running a lost task decides the same way. A key counts as hot above
``hot_rows`` rows and a share of 1/MAX_HOT_KEYS of all rows, so at most MAX_HOT_KEYS
keys qualify, which bounds the driver's list and the broadcast; a key below both is
no larger than other tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from slatewright.session import written

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 50_000
#: rows per range, however small ``hot_rows`` is: a shuffle has a block, and the written table a file, for
#: every range, so ranges of a fixed few rows would cost the square of the log
RANGE_ROWS = 1_000_000
#: but at least so many ranges where ``hot_rows`` asks for them
FEW_RANGES = 64

_HOT, _SLICE, _GROUP, _KEY, _RANGE, _SPREAD = "_hot", "_slice", "_group", "_key", "_range", "_spread"


def _hot_counts(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, list[tuple]]:
    """The key columns, and the hot keys with their number of rows. No keys means the whole frame is the group."""
    frame = df.select(*keys) if keys else df.select(F.lit(0).alias(_GROUP))
    spark = df.sparkSession
    memo = (spark.sparkContext.applicationId, frame.semanticHash(), frame.schema.simpleString(), hot_rows)
    rows = _counted.get(memo)
    if rows is None:
        counts = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_n"))
        found = counts.where(F.col("_n") > hot_rows).orderBy(F.desc("_n")).limit(MAX_HOT_KEYS).collect()
        # the share only matters once the list is full
        floor = df.count() / MAX_HOT_KEYS if len(found) == MAX_HOT_KEYS else 0
        rows = [tuple(r) for r in found if r["_n"] > floor]
        if len(_counted) >= 256:
            _counted.clear()
        _counted[memo] = rows
    return frame, rows


# which keys of a frame were hot when last counted; a stale answer costs balance, never rows
_counted: dict[tuple, list] = {}


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys as a local frame; None when there is none."""
    frame, rows = _hot_counts(df, keys, hot_rows)
    return df.sparkSession.createDataFrame([r[:-1] for r in rows], frame.schema).withColumn(_HOT, F.lit(True)) if rows else None


def range_count(rows: int, hot_rows: int) -> int:
    """Ranges of about ``hot_rows`` rows, but no more than ``FEW_RANGES`` or one per ``RANGE_ROWS`` rows."""
    return min(rows // max(1, hot_rows) + 1, max(FEW_RANGES, rows // RANGE_ROWS + 1))


def slice_hot(df: DataFrame, keys: Sequence[str], slice_by: Column, hot: DataFrame) -> DataFrame:
    """Add the slice number: 0 for ordinary keys, ``slice_by`` for hot ones."""
    return df.join(F.broadcast(hot), list(keys), "left").withColumn(
        _SLICE, F.when(F.col(_HOT), slice_by.cast("long")).otherwise(F.lit(0).cast("long"))
    )


def spread_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """A hash of the columns, to tell rows apart whose order doesn't matter."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns if not isinstance(df.schema[c].dataType, MapType)])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    inclusive: bool = False,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Append running columns per key along ``order`` (which must be a total order).

    sums:     sum over the rows before this one (this one too when ``inclusive``)
    previous: value on the row just before
    latest:   last non-null value up to and including this row
    No keys means the whole frame. Rows with a null key are a group of their own.
    ``counted`` is a cheaper frame with (about) the same keys per row, used to find hot keys.
    """
    sums, previous, latest = dict(sums or {}), dict(previous or {}), dict(latest or {})
    out_columns = df.columns
    frame, hot = _hot_counts(df if counted is None else counted, keys, hot_rows)
    df = df.withColumns(
        {
            **{f"_s_{n}": c for n, c in sums.items()},
            **{f"_p_{n}": c for n, c in previous.items()},
            **{f"_l_{n}": c for n, c in latest.items()},
        }
    )
    parts = {"sums": list(sums), "previous": list(previous), "latest": list(latest)}
    if not hot:
        if not keys:
            df, keys = df.withColumn(_GROUP, F.lit(0)), [_GROUP]
        swept = _windowed(df, list(keys), order, inclusive, **parts)
        return swept.select(*out_columns, *sums, *previous, *latest)
    ranges = range_count(sum(r[-1] for r in hot), hot_rows)
    if not keys:
        swept = _scanned(df.withColumn(_KEY, F.struct(F.lit(0).alias(_GROUP))), order, inclusive, ranges, **parts)
        return swept.select(*out_columns, *sums, *previous, *latest)
    known = df.sparkSession.createDataFrame([r[:-1] for r in hot], frame.schema)
    known = F.broadcast(known.select(F.struct(*keys).alias("_known")))
    # structs of keys are equal where their nulls are
    df = df.withColumn(_KEY, F.struct(*keys))
    same = F.col(_KEY) == F.col("_known")
    rest = _windowed(df.join(known, same, "left_anti"), list(keys), order, inclusive, **parts)
    busy = _scanned(df.join(known, same, "left_semi"), order, inclusive, ranges, **parts)
    columns = [*out_columns, *sums, *previous, *latest]
    return rest.select(*columns).unionByName(busy.select(*columns))


def _windowed(
    df: DataFrame, keys: list[str], order: Sequence[str], inclusive: bool, sums: list[str], previous: list[str], latest: list[str]
) -> DataFrame:
    """The running columns by a plain window; ``previous`` of a first row and ``latest`` before any value are null."""
    along = W.partitionBy(*keys).orderBy(*order)
    upto = along.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    through = along.rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns(
        {
            **{n: F.coalesce(F.sum(f"_s_{n}").over(upto), F.lit(0)) for n in sums},
            **{n: F.lag(f"_p_{n}").over(along) for n in previous},
            **{n: F.last(f"_l_{n}", ignorenulls=True).over(through) for n in latest},
        }
    )


def _scanned(
    df: DataFrame, order: Sequence[str], inclusive: bool, ranges: int, sums: list[str], previous: list[str], latest: list[str]
) -> DataFrame:
    """The same by a prefix scan over ranges of (``_key``, order).

    The ranges are written, so that windows and carries see the same ones whatever is run again.
    """
    dealt = df.repartitionByRange(ranges, _KEY, *order).withColumn(_RANGE, F.spark_partition_id())
    dealt = written(dealt, "ranges")
    place = F.struct(*order)
    boxed = lambda n: F.struct(F.col(f"_p_{n}").alias("v"))  # noqa: E731  a null before a range is not the same as no row
    totals = dealt.groupBy(_KEY, _RANGE).agg(
        *[F.sum(f"_s_{n}").alias(f"_c_{n}") for n in sums],
        *[F.max_by(boxed(n), place).alias(f"_c_{n}") for n in previous],
        *[F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), place)).alias(f"_c_{n}") for n in latest],
    )
    before = W.partitionBy(_KEY).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        _KEY,
        _RANGE,
        *[F.sum(f"_c_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_c_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in [*previous, *latest]],
    )
    first = F.row_number().over(W.partitionBy(_KEY, _RANGE).orderBy(*order)) == 1
    swept = _windowed(dealt.withColumn("_first", first), [_KEY, _RANGE], order, inclusive, sums, previous, latest)
    joined = swept.join(carry, [_KEY, _RANGE])
    return joined.withColumns(
        {
            **{n: F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)) for n in sums},
            **{n: F.when(F.col("_first"), F.col(f"_c_{n}")["v"]).otherwise(F.col(n)) for n in previous},
            **{n: F.coalesce(n, f"_c_{n}") for n in latest},
        }
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    right_time_as: str,
    tie: Sequence[str] = (),
    strict: bool = False,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Equal right times: the last by ``tie`` (columns of ``right``) wins. ``strict``
    takes only right rows before the left time. Rows without a key are dropped.
    A name in ``columns`` that ``left`` has too is replaced by the right value.
    One exchange: both sides are stacked and swept in time order.
    """
    keep = [c for c in left.columns if c not in set(columns) and c != right_time_as]
    lefts = left.where(F.col(key).isNotNull()).select(
        F.col(key),
        F.col(left_time).cast("timestamp").alias("_t"),
        F.lit(0 if strict else 1).alias("_side"),
        F.lit(None).cast(_tie_type(right, tie)).alias("_tie"),
        spread_of(left, keep).alias(_SPREAD),  # left rows of one time may stand in any order
        F.struct(*[c for c in keep if c != key]).alias("_left"),
    )
    rights = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key),
        F.col(right_time).cast("timestamp").alias("_t"),
        F.lit(1 if strict else 0).alias("_side"),
        F.struct(*tie).alias("_tie") if tie else F.lit(None).cast("int").alias("_tie"),
        F.struct(*columns, F.col(right_time).alias("_rt")).alias("_right"),
    )
    stacked = lefts.unionByName(rights, allowMissingColumns=True)
    counted = lefts.select(key).union(rights.select(key)) if counted is None else counted
    swept = running(
        stacked,
        [key],
        ["_t", "_side", "_tie", _SPREAD],
        latest={"_hit": F.col("_right")},
        hot_rows=hot_rows,
        counted=counted,
    )
    return swept.where(F.col("_left").isNotNull()).select(
        *[F.col(c) if c == key else F.col(f"_left.{c}").alias(c) for c in keep],
        *[F.col(f"_hit.{c}").alias(c) for c in columns],
        F.col("_hit._rt").alias(right_time_as),
    )


def _tie_type(right: DataFrame, tie: Sequence[str]):
    return right.select(F.struct(*tie)).schema[0].dataType if tie else "int"


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    seconds: int,
    measures: Mapping[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Append sums of integer ``measures`` over [t - seconds, t - 1s] per key.

    A RANGE frame re-adds its rows for every row, quadratic for a busy key. Here
    each contributing row leaves two marks, one where it enters the trailing
    window and one (negated) where it leaves it, and a running sum over marks
    and rows answers every row in one sweep. A row without a time has an empty window.
    """
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    names = list(measures)
    base = df.where(F.col(time).isNotNull())
    probes = base.select(
        *keys,
        second.alias("_sec"),
        F.lit(1).alias("_kind"),
        spread_of(df, df.columns).alias(_SPREAD),  # rows of one second may stand in any order
        F.struct(*df.columns).alias("_row"),
        *[F.lit(0).cast("long").alias(n) for n in names],
    )
    contributes = None
    for column in measures.values():
        some = F.coalesce(column, F.lit(0)) != 0
        contributes = some if contributes is None else contributes | some
    sources = base.where(contributes).select(
        *keys, second.alias("_sec"), *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in measures.items()]
    )
    # rows of one key and second merge before the exchange
    merged = sources.groupBy(*keys, "_sec").agg(*[F.sum(n).alias(n) for n in names])
    marks = merged.select(
        *keys,
        F.explode(
            F.array(
                F.struct((F.col("_sec") + 1).alias("_sec"), F.lit(1).cast("long").alias("_sign")),
                F.struct((F.col("_sec") + 1 + seconds).alias("_sec"), F.lit(-1).cast("long").alias("_sign")),
            )
        ).alias("_mark"),
        *names,
    ).select(
        *keys,
        F.col("_mark._sec").alias("_sec"),
        F.lit(0).alias("_kind"),
        *[(F.col(n) * F.col("_mark._sign")).alias(n) for n in names],
    )
    stacked = probes.unionByName(marks, allowMissingColumns=True).withColumnsRenamed({n: f"_m_{n}" for n in names})
    swept = running(
        stacked,
        keys,
        ["_sec", "_kind", _SPREAD],
        sums={n: F.col(f"_m_{n}") for n in names},
        inclusive=True,
        hot_rows=hot_rows,
        counted=base.select(*keys),
    )
    timeless = df.where(F.col(time).isNull()).withColumns({n: F.lit(0).cast("long") for n in names})
    return swept.where(F.col("_row").isNotNull()).select("_row.*", *names).unionByName(timeless)


def softmax(
    df: DataFrame, keys: Sequence[str], scores: Mapping[str, str], spread_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Append exp(s - max) / sum(exp(s - max)) per key for every ``{output: score}``.

    A hot key is spread over salts (a hash of ``spread_by``); each salt keeps its
    own maximum and sum, and the salts of one key merge as (max, rescaled sum).
    """
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        sliced, local = df, W.partitionBy(*keys)
    else:
        sliced = slice_hot(df, keys, F.pmod(F.xxhash64(*spread_by), F.lit(256)), hot)
        local = W.partitionBy(*keys, _SLICE)
    peaked = sliced.withColumns({f"_m_{o}": F.max(s).over(local) for o, s in scores.items()})
    summed = peaked.withColumns(
        {f"_z_{o}": F.sum(F.exp(F.col(s) - F.col(f"_m_{o}"))).over(local) for o, s in scores.items()}
    )
    if hot is None:
        return summed.select(
            *df.columns,
            *[(F.exp(F.col(s) - F.col(f"_m_{o}")) / F.col(f"_z_{o}")).alias(o) for o, s in scores.items()],
        )
    parts = (
        summed.where(F.col(_HOT))
        .groupBy(*keys, _SLICE)
        .agg(
            *[F.first(f"_m_{o}").alias(f"_m_{o}") for o in scores],
            *[F.first(f"_z_{o}").alias(f"_z_{o}") for o in scores],
        )
    )
    whole = W.partitionBy(*keys)
    peaks = parts.withColumns({f"_gm_{o}": F.max(f"_m_{o}").over(whole) for o in scores})
    merged = peaks.select(
        *keys,
        _SLICE,
        *[f"_gm_{o}" for o in scores],
        *[
            F.sum(F.col(f"_z_{o}") * F.exp(F.col(f"_m_{o}") - F.col(f"_gm_{o}"))).over(whole).alias(f"_gz_{o}")
            for o in scores
        ],
    )
    joined = summed.join(merged, [*keys, _SLICE], "left")
    return joined.select(
        *df.columns,
        *[
            (F.exp(F.col(s) - F.coalesce(f"_gm_{o}", f"_m_{o}")) / F.coalesce(f"_gz_{o}", f"_z_{o}")).alias(o)
            for o, s in scores.items()
        ],
    )
