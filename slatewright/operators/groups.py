"""Per-group picks: newest row, most frequent value, top-k, keep-first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int | Column, rank_as: str = "rank", dense: bool = False
) -> DataFrame:
    """First ``k`` rows per key. The rank filter is applied by Spark on the map
    side too (window group limit), so a large group never reaches one task."""
    rank = F.dense_rank() if dense else F.row_number()
    return df.withColumn(rank_as, rank.over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank_as) <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_first").drop("_first")


def latest_row(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str]) -> DataFrame:
    """Newest row per key; a null time counts as the oldest."""
    order = [F.col(time).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in tie]]
    return keep_first(df, keys, order)


def most_frequent(
    df: DataFrame, keys: Sequence[str], values: dict[str, str], weight: Column | None = None
) -> DataFrame:
    """Most frequent non-null value of each column per key, alphabetical among equals.

    ``values`` maps column to output name; ``weight`` counts a row more than once.
    All columns go through the same two aggregations, both with map-side merging.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in values])
    tall = df.select(*keys, (F.lit(1) if weight is None else weight).alias("_w"), F.explode(pairs).alias("_p"))
    counts = tall.groupBy(*keys, "_p").agg(F.sum("_w").alias("_n"))
    v, n = F.col("_p.v"), F.col("_n")
    return counts.groupBy(*keys).agg(
        *[
            F.min_by(v, F.when((F.col("_p.c") == c) & v.isNotNull(), F.struct(-n, v))).alias(name)
            for c, name in values.items()
        ]
    )


def last_known(value: Column, place: Column) -> Column:
    """Aggregate: the non-null value at the greatest place."""
    return F.max_by(value, F.when(value.isNotNull(), place))
