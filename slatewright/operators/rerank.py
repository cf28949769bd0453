"""Greedy diversity reranking of whole slates.

Each step picks the best score after a penalty per already picked item of the
same category and source. The fold needs a slate in one place, so a slate is
first cut to the rows that can still win, exactly:

* within one (category, source) pair only the best k rows can be picked;
* among pairs of one category, k better pairs leave at least one whose source is
  still unpicked (k - 1 picks touch at most k - 1 sources), which beats any later
  pair; the same for pairs of one source;
* of the remaining pairs, picks touch at most k - 1 categories and k - 1 sources,
  hence at most 2k(k - 1) pairs; any pair ranked later is beaten by an untouched one.

At most (2k(k - 1) + 1) * k rows per slate are left whatever its size, and each cut
is a rank filter Spark also applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.groups import top_k
from slatewright.operators.position import median_within
from slatewright.operators.running import hot_keys
from slatewright.session import written

# rows a single fold may hold before its slate is cut
LARGE_SLATE = 5_000

_PICKS = "array<struct<pos:int,category_penalty:double,source_penalty:double,final_score:double>>"


def prune(df: DataFrame, slate: Sequence[str], score: str, tie: str, k: int) -> DataFrame:
    """Drop rows that cannot be among the k greedy picks."""
    pair = [*slate, "category", "source"]
    best_first = [F.desc(score), F.asc(tie)]
    rows = top_k(df, pair, best_first, k, "_in_pair")
    lead = W.partitionBy(*pair).orderBy(*best_first).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumns({"_lead": F.first(score).over(lead), "_lead_tie": F.first(tie).over(lead)})
    pair_order = [F.desc("_lead"), F.asc("_lead_tie")]
    rows = top_k(rows, [*slate, "category"], pair_order, k, "_in_category", dense=True)
    rows = top_k(rows, [*slate, "source"], pair_order, k, "_in_source", dense=True)
    rows = top_k(rows, slate, pair_order, 2 * k * (k - 1) + 1, "_in_slate", dense=True)
    return rows.select(*df.columns)


def _cut_large(df: DataFrame, slate: Sequence[str], score: str, tie: str, k: int) -> DataFrame:
    """Prune the slates above ``LARGE_SLATE`` rows; shorter ones are folded as they are."""
    keys = list(slate)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LARGE_SLATE).select(*keys)
    if large.isEmpty():
        return df
    large = written(large, "large")
    rest = df.join(large, keys, "left_anti").select(*df.columns)
    return rest.unionByName(prune(df.join(large, keys, "left_semi").select(*df.columns), keys, score, tie, k))


def _fold(scores: np.ndarray, inside: np.ndarray, cats: np.ndarray, srcs: np.ndarray, steps: int, wc: float, ws: float):
    """Greedy picks for a block of padded slates; rows without a score (NaN) follow the scored ones in their order."""
    rows = np.arange(len(scores))
    seen_c, seen_s = np.zeros(scores.shape), np.zeros(scores.shape)
    # infinities compare as the largest numbers there are, so that -inf can stand for closed rows
    finite = np.clip(scores, np.finfo(float).min, np.finfo(float).max)
    scored, open_ = inside & ~np.isnan(scores), inside.copy()
    out = []
    for _ in range(steps):
        adjusted = np.where(open_ & scored, finite - seen_c * wc - seen_s * ws, -np.inf)
        at = np.where((open_ & scored).any(axis=1), adjusted.argmax(axis=1), open_.argmax(axis=1))
        lost_c, lost_s = seen_c[rows, at] * wc, seen_s[rows, at] * ws
        out.append((at, lost_c, lost_s, scores[rows, at] - lost_c - lost_s))
        open_[rows, at] = False
        seen_c += cats == cats[rows, at][:, None]
        seen_s += srcs == srcs[rows, at][:, None]
    return [np.stack(column, axis=1) for column in zip(*out)]


def _codes(values: pa.Array) -> np.ndarray:
    return pa.compute.fill_null(values.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)


def _pick_udf(k: int, category_weight: float, source_weight: float):
    def picks(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for scores, cats, srcs in batches:
            sizes = scores.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = scores.flatten().to_numpy(zero_copy_only=False).astype(float)  # null is NaN
            cat, src = _codes(cats.flatten()), _codes(srcs.flatten())
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
            kept = np.minimum(sizes, k)
            ends = np.cumsum(kept)
            columns = [np.empty(int(kept.sum())) for _ in range(4)]
            order = np.argsort(sizes, kind="stable")
            lo = 0
            while lo < len(order):
                # slates of similar size share a block of about 4 million cells
                hi = lo + 1
                while hi < len(order) and sizes[order[hi]] * (hi + 1 - lo) <= 4_000_000:
                    hi = min(len(order), lo + max(hi + 1 - lo, 2 * (hi - lo)))
                    if sizes[order[hi - 1]] * (hi - lo) > 4_000_000:
                        hi = lo + max(1, (hi - lo) // 2)
                        break
                block, lo = order[lo:hi], hi
                width = int(sizes[block].max())
                if width == 0:
                    continue
                lane = np.arange(width)
                inside = lane < sizes[block][:, None]
                index = np.where(inside, starts[block][:, None] + lane, 0)
                folded = _fold(flat[index], inside, cat[index], src[index], min(k, width), category_weight, source_weight)
                step = np.arange(min(k, width))
                real = step < kept[block][:, None]
                slot = (ends[block] - kept[block])[:, None] + step
                for column, values in zip(columns, folded):
                    column[slot[real]] = values[real]
            fields = pa.StructArray.from_arrays(
                [pa.array(columns[0].astype(np.int32)), *[pa.array(c, from_pandas=True) for c in columns[1:]]],
                names=["pos", "category_penalty", "source_penalty", "final_score"],
            )
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), fields)

    return F.arrow_udf(picks, _PICKS)


def greedy_rerank(
    df: DataFrame,
    slate: Sequence[str],
    score: str,
    k: int = 10,
    category_weight: float = 0.08,
    source_weight: float = 0.10,
    tie: str = "item_id",
    rank_as: str = "final_rank",
    bounded: bool = False,
) -> DataFrame:
    """Rows of every slate in greedy order with penalties, ``final_score`` and rank.

    Equal adjusted scores go to the higher raw score, then the smaller ``tie``.
    Rows whose score is null or NaN come after all others, by ``tie``, with a null ``final_score``.
    ``bounded`` skips the cut for slates whose length a parameter already limits.
    """
    rest = [c for c in df.columns if c not in slate]
    clean = df.withColumn("_score", S.number(score, None))
    pool = clean if bounded else _cut_large(clean, slate, "_score", tie, k)
    slates = pool.groupBy(*slate).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.isnull("_score").alias("_none"), (-F.col("_score")).alias("_neg"), F.col(tie).alias("_tie"),
                    F.struct(*rest).alias("row"),
                )
            )
        ).alias("_rows")
    )
    rows = F.col("_rows")
    picked = slates.withColumn(
        "_picks",
        _pick_udf(k, category_weight, source_weight)(
            F.transform(rows, lambda r: -r["_neg"]),
            F.transform(rows, lambda r: r["row"]["category"]),
            F.transform(rows, lambda r: r["row"]["source"]),
        ),
    )
    # the outer form adds no emptiness test, which would run the fold a second time
    return picked.select(*slate, "_rows", F.posexplode_outer("_picks").alias("_step", "_pick")).select(
        *slate,
        *[F.col("_rows")[F.col("_pick.pos")]["row"][c].alias(c) for c in rest],
        F.col("_pick.category_penalty").alias("category_repeat_penalty"),
        F.col("_pick.source_penalty").alias("source_repeat_penalty"),
        F.col("_pick.final_score").alias("final_score"),
        (F.col("_step") + 1).alias(rank_as),
    )


def with_freshness(df: DataFrame, slate: Sequence[str], age: str = "age_hours", max_bonus: float = 0.15) -> DataFrame:
    """Add ``freshness_bonus``; a missing age takes the median age of its slate.

    The median is looked up only where some age is missing.
    """
    gaps = df.where(F.col(age).isNull()).select(*slate).distinct()
    if gaps.isEmpty():
        return df.withColumn("freshness_bonus", S.freshness_bonus(age, max_bonus))
    keys = list(slate)
    aged = written(df.select(*keys, age).join(gaps, keys, "left_semi"), "ages")
    large = hot_keys(aged, keys, LARGE_SLATE)
    plain = aged if large is None else aged.join(F.broadcast(large), keys, "left_anti")
    medians = plain.groupBy(*keys).agg(F.percentile(age, 0.5).alias("_median"))
    if large is not None:
        inside = aged.join(F.broadcast(large), keys, "left_semi")
        medians = medians.unionByName(median_within(inside, keys, age, "_median"))
    filled = df.join(medians, list(slate), "left")
    return filled.withColumn("freshness_bonus", S.freshness_bonus(F.coalesce(age, "_median"), max_bonus)).select(
        *df.columns, "freshness_bonus"
    )


def rerank_v1(
    scored: DataFrame, slate: Sequence[str], k: int = 10, freshness_weight: float = 1.0, bounded: bool = False
) -> DataFrame:
    """model_score + weighted freshness, then greedy with penalties .08 / .10; rows without a score come last."""
    fresh = with_freshness(scored, slate)
    prepared = fresh.withColumn(
        "preliminary_score", F.col("model_score") + F.lit(freshness_weight) * F.coalesce("freshness_bonus", F.lit(0.0))
    )
    return greedy_rerank(prepared, slate, "preliminary_score", k, bounded=bounded)


def rerank_v2(scored: DataFrame, slate: Sequence[str], k: int = 10, bounded: bool = False) -> DataFrame:
    """model_score + .05 retrieval + .20 recency, then greedy with penalties .05 / .05; a sum that is null or NaN is 0."""
    def part(name: str) -> Column:
        return S.number(name) if name in scored.columns else F.lit(0.0)

    prepared = scored.withColumns(
        {
            "retrieval_bonus": F.lit(0.05) * part("blended_retrieval_score"),
            "freshness_bonus": F.lit(0.20) * part("recency_decay"),
            "source": S.known("source"),
            "category": S.known("category"),
        }
    ).withColumn("base_final_score", S.number(F.col("model_score") + F.col("retrieval_bonus") + F.col("freshness_bonus")))
    return greedy_rerank(
        prepared, slate, "base_final_score", k, 0.05, 0.05, rank_as="rank", bounded=bounded
    )
