"""Weighted sampling without replacement per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatewright.operators.groups import top_k


def hash_uniform(columns: Sequence[str], seed: int = 42) -> Column:
    """Reproducible uniform number in (0, 1) from the first 8 md5 hex digits."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def weighted_sample(
    df: DataFrame, keys: Sequence[str], weight: str, ids: Sequence[str], k: int, seed: int = 42, rank_as: str = "rank_position"
) -> DataFrame:
    """k rows per key, drawn one after another with chance proportional to weight.

    The k smallest -ln(u)/w are such a draw, so it is a plain top-k and needs no
    pass over the group's total weight.
    """
    draw = -F.log(hash_uniform([*keys, *ids], seed)) / F.greatest(F.col(weight), F.lit(1e-6))
    drawn = df.withColumn("_draw", draw)
    return top_k(drawn, keys, [F.asc("_draw"), *[F.asc(i) for i in ids]], k, rank_as).drop("_draw")


def slate_weight(
    category_match: Column,
    source_match: Column,
    recency: Column,
    secondary_match: Column | None = None,
    quality: Column | None = None,
    popularity: Column | None = None,
    novelty: float = 0.5,
    quality_preference: float = 0.5,
) -> Column:
    """Catalogue weight of an item for a user (later form of the draw)."""
    none = F.lit(0.0)
    return (
        F.lit(1.0)
        + F.lit(1.8) * category_match
        + F.lit(0.8) * (none if secondary_match is None else secondary_match)
        + F.lit(1.0) * source_match
        + F.lit(novelty * 0.6) * recency
        + F.lit(quality_preference * 0.5) * (none if quality is None else quality)
        + F.lit(0.4) * (none if popularity is None else popularity)
    )


def slate_weight_v2(category_match: Column, source_match: Column, recency: Column) -> Column:
    """Earlier form of the draw."""
    return F.lit(1.0) + F.lit(1.5) * category_match + F.lit(1.0) * source_match + F.lit(0.5) * recency
