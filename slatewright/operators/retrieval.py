"""Candidate retrieval for all users in one plan.

Popular, recent, per-category and per-source lists depend on items only, so they
are built once from one pre-aggregated (item, category, source) table. Lists that
are the same for everybody have a length fixed by a parameter and reach the user
rows as scalar subqueries; per-category and per-source lists join on the user's
preference. All five lists stay arrays on the user's single row until the blend,
so users are shuffled once and items are never paired with users beyond the lists.
Entries are ids, scores and labels only: the item's own columns, many times as wide,
join the blended candidates, so that no sort or exchange of lists holds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatewright.operators.groups import last_known, most_frequent, top_k
from slatewright.operators.running import running
from slatewright.session import written

# fixed values: strategy weights, in blend order
STRATEGY_WEIGHTS = {
    "popular": 1.00,
    "recent": 0.90,
    "unseen_recent": 0.95,
    "category_match": 1.10,
    "source_match": 1.05,
}
HEAD_ITEMS = 256


def item_base(impressions: DataFrame) -> DataFrame:
    """One row per (item, category, source): clicks, impressions, newest (time, row)."""
    return impressions.groupBy("item_id", "category", "source").agg(
        F.sum("clicked").alias("clicks"),
        F.count(F.lit(1)).alias("shown"),
        F.max(F.struct("impression_time", "event_id")).alias("newest"),
    )


def pair_base(impressions: DataFrame) -> DataFrame:
    """One row per (user, item, category, source): all that retrieval needs from the log."""
    place = F.struct("impression_time", "event_id")
    given = [
        F.max(F.when(F.col(n).isNotNull(), F.struct(place, F.col(n).alias("v")))).alias(f"_given_{n}")
        for n in ("preferred_category", "preferred_source")
        if n in impressions.columns
    ]
    return impressions.groupBy("user_id", "item_id", "category", "source").agg(
        F.sum("clicked").alias("clicks"), F.count(F.lit(1)).alias("shown"), F.max(place).alias("newest"), *given
    )


def _rolled(base: DataFrame, *keys: str) -> DataFrame:
    """Roll the base up; a source or category that is not a key becomes its last known value."""
    picked = [
        last_known(F.col(c), F.col("newest")).alias(f"last_{c}") for c in ("source", "category")
    ]
    return base.groupBy(*keys).agg(
        F.sum("clicks").alias("clicks"),
        F.sum("shown").alias("shown"),
        F.max("newest.impression_time").alias("last_seen_time"),
        F.max_by(F.struct("source", "category"), F.col("newest")).alias("newest_row"),
        *picked,
    )


def item_stats(impressions: DataFrame) -> DataFrame:
    return _rolled(item_base(impressions), "item_id")



def _popular_order() -> list[Column]:
    return [F.desc("clicks"), F.desc("shown"), F.desc("last_seen_time"), F.asc("item_id")]


def _recent_order() -> list[Column]:
    return [F.desc_nulls_last("last_seen_time"), F.asc("item_id")]


def popular(stats: DataFrame, k: int = 20) -> DataFrame:
    return stats.orderBy(*_popular_order()).limit(k).select(
        "item_id",
        "last_seen_time",
        F.col("last_source").alias("source"),
        F.col("last_category").alias("category"),
        F.lit("popular").alias("retrieval_strategy"),
        F.col("clicks").cast("double").alias("retrieval_score"),
    )


def _numbered_recent(stats: DataFrame, k: int) -> DataFrame:
    """The k newest items with place 1..k (a single small partition after the limit)."""
    head = stats.orderBy(*_recent_order()).limit(k)
    return head.withColumn("place", F.row_number().over(W.orderBy(*_recent_order())))


def recent(stats: DataFrame, k: int = 20) -> DataFrame:
    placed = _numbered_recent(stats, k)
    return placed.select(
        "item_id",
        "last_seen_time",
        F.col("newest_row.source").alias("source"),
        F.col("newest_row.category").alias("category"),
        F.lit("recent").alias("retrieval_strategy"),
        (F.count(F.lit(1)).over(W.partitionBy()) - F.col("place") + 1).cast("double").alias("retrieval_score"),
    )


def by_attribute(base: DataFrame, attribute: str, k: int = 20) -> DataFrame:
    """Top k items of every category (or source), keyed by ``key``."""
    strategy = f"{attribute}_match"
    rolled = _rolled(base.where(F.col(attribute).isNotNull()), attribute, "item_id")
    return top_k(rolled, [attribute], _popular_order(), k).select(
        F.col(attribute).alias("key"),
        "item_id",
        "last_seen_time",
        F.col("last_source").alias("source"),
        F.col("last_category").alias("category"),
        F.lit(strategy).alias("retrieval_strategy"),
        F.col("clicks").cast("double").alias("retrieval_score"),
    )


def preferences(impressions: DataFrame) -> DataFrame:
    """Per user: last non-null preferred_* if the column exists, else the most frequent value seen."""
    return _preferences(pair_base(impressions))


def _preferences(pairs: DataFrame) -> DataFrame:
    names = {"category": "preferred_category", "source": "preferred_source"}
    usual = most_frequent(pairs, ["user_id"], names, F.col("shown"))
    given = [n for n in names.values() if f"_given_{n}" in pairs.columns]
    if not given:
        return usual
    last = pairs.groupBy("user_id").agg(*[F.max(f"_given_{n}")["v"].alias(f"_{n}") for n in given])
    return usual.join(last, "user_id").select(
        "user_id", *[F.coalesce(f"_{n}", n).alias(n) if n in given else F.col(n) for n in names.values()]
    )


def _with_item(df: DataFrame, item_columns: DataFrame | None) -> DataFrame:
    """Attach the item's own columns as one struct; by broadcast, which keeps users together, where the items are few."""
    if item_columns is None:
        return df
    packed = item_columns.select(
        "item_id", F.struct(*[c for c in item_columns.columns if c != "item_id"]).alias("item")
    )
    return df.join(packed, "item_id", "left")


def _entry() -> Column:
    names = ["item_id", "last_seen_time", "source", "category", "retrieval_strategy", "retrieval_score"]
    return F.struct(*names)


def unseen(impressions: DataFrame, k: int = 20, head: int = HEAD_ITEMS, stats: DataFrame | None = None) -> DataFrame:
    """Per user the k newest items the user has not been shown; score n..1."""
    stats = written(item_stats(impressions), "items") if stats is None else stats
    lists = _unseen_lists(impressions, stats, k, head)
    return lists.select("user_id", F.explode("_own").alias("_e")).select("user_id", "_e.*")


def _unseen_lists(seen_log: DataFrame, stats: DataFrame, k: int, head: int) -> DataFrame:
    """One row per user with the list of unseen newest items.

    The ``head`` newest items form a bounded list. A user who has not seen k of
    them is answered inside the list (set difference of places, no join with
    items). Only users who saw more than head - k of the newest items go on to
    the tail, where a user with s seen items needs global places up to k + s:
    they meet the items in blocks of places, so the work grows with s.
    """
    newest = _numbered_recent(stats, head)
    rows = newest.select(
        "item_id",
        "place",
        "last_seen_time",
        F.col("newest_row.source").alias("source"),
        F.col("newest_row.category").alias("category"),
        F.lit("unseen_recent").alias("retrieval_strategy"),
        F.lit(0.0).alias("retrieval_score"),
    )
    listed = rows.agg(F.sort_array(F.collect_list(F.struct("place", _entry().alias("entry")))).alias("l")).scalar()
    length = newest.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()

    places = newest.select("item_id", "place")
    seen = (
        seen_log.join(F.broadcast(places), "item_id", "left").groupBy("user_id").agg(F.collect_set("place").alias("seen"))
    )
    free = seen.select(
        "user_id",
        F.when(length > 0, F.array_except(F.sequence(F.lit(1), F.greatest(length, F.lit(1))), F.col("seen")))
        .otherwise(F.array().cast("array<int>"))
        .alias("free"),
    )
    # the list is complete when it holds every item, else k free places are needed
    complete = (F.size("free") >= k) | (length < head)
    kept = free.where(complete).select("user_id", F.slice("free", 1, k).alias("_kept"), listed.alias("_items"))
    in_head = kept.select(
        "user_id",
        F.transform(
            "_kept",
            lambda p, i: F.get(F.col("_items"), p - 1)["entry"].withField(
                "retrieval_score", (F.size("_kept") - i).cast("double")
            ),
        ).alias("_own"),
    )
    users = free.where(~complete).select("user_id")
    if users.isEmpty():
        return in_head
    return in_head.unionByName(_unseen_tail(seen_log, stats, users, k))


def _unseen_tail(seen_log: DataFrame, stats: DataFrame, users: DataFrame, k: int, block: int = 64) -> DataFrame:
    aged = stats.withColumn("_age", -F.unix_micros(F.col("last_seen_time").cast("timestamp")))
    placed = running(
        aged,
        [],
        ["_age", "item_id"],
        sums={"place": F.lit(1).cast("long")},
    ).withColumn("_block", F.floor(F.col("place") / block))
    seen = seen_log.join(users, "user_id", "left_semi").select("user_id", "item_id").distinct()
    reach = seen.groupBy("user_id").agg((F.count(F.lit(1)) + k).alias("_reach"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor(F.col("_reach") / block))
    wanted = reach.select("user_id", "_reach", F.explode(blocks).alias("_block"))
    near = wanted.join(placed, "_block").where(F.col("place") < F.col("_reach"))
    free = near.join(seen, ["user_id", "item_id"], "left_anti")
    kept = top_k(free, ["user_id"], [F.asc("place")], k, "_pos")
    # n is below k only when the user has seen nearly every item
    sized = kept.select(
        "user_id",
        "item_id",
        "last_seen_time",
        F.col("newest_row.source").alias("source"),
        F.col("newest_row.category").alias("category"),
        F.lit("unseen_recent").alias("retrieval_strategy"),
        (F.count(F.lit(1)).over(W.partitionBy("user_id")) - F.col("_pos") + 1).cast("double").alias("retrieval_score"),
    )
    return sized.groupBy("user_id").agg(F.collect_list(_entry()).alias("_own"))


def retrieve(
    impressions: DataFrame,
    users: DataFrame | None = None,
    each_k: int = 20,
    final_k: int = 50,
    head: int = HEAD_ITEMS,
    item_columns: DataFrame | None = None,
) -> DataFrame:
    """Blended candidates for every user (or the ``users`` asked for, known or not).

    ``item_columns`` (keyed by item_id) come back as the struct ``item``.
    """
    # the log is read once; everything below starts from these two tables
    pairs = written(pair_base(impressions), "pairs")
    base = written(
        pairs.groupBy("item_id", "category", "source").agg(
            F.sum("clicks").alias("clicks"), F.sum("shown").alias("shown"), F.max("newest").alias("newest")
        ),
        "items",
    )
    stats = _rolled(base, "item_id")
    prefs = _preferences(pairs).withColumn("_known", F.lit(True))
    if users is not None:
        prefs = users.select("user_id").distinct().join(prefs, "user_id", "left")

    def listing(df: DataFrame, name: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.collect_list(_entry()).alias(name))

    top, newest = popular(stats, each_k), recent(stats, each_k)
    everyone = listing(top.unionByName(newest), "l").scalar()
    # a user never seen before has seen nothing: the newest items are all unseen
    fresh = listing(newest.withColumn("retrieval_strategy", F.lit("unseen_recent")), "l").scalar()
    rows = (
        prefs.join(_unseen_lists(pairs, stats, each_k, head), "user_id", "left")
        .join(listing(by_attribute(base, "category", each_k), "_cat", "key"), F.col("preferred_category") == F.col("key"), "left")
        .drop("key")
        .join(listing(by_attribute(base, "source", each_k), "_src", "key"), F.col("preferred_source") == F.col("key"), "left")
    )
    lists = rows.select(
        "user_id",
        F.explode_outer(
            F.flatten(
                F.array_compact(
                    F.array(everyone, F.when(F.col("_known"), F.col("_own")).otherwise(fresh), F.col("_cat"), F.col("_src"))
                )
            )
        ).alias("_e"),
    )
    return _with_item(blend(lists.where(F.col("_e").isNotNull()).select("user_id", "_e.*"), final_k), item_columns)


def retrieve_each(
    impressions: DataFrame,
    asks: DataFrame,
    each_k: Column,
    final_k: Column,
    most: int,
    head: int = HEAD_ITEMS,
    item_columns: DataFrame | None = None,
) -> DataFrame:
    """Blended candidates for every ask (user_id, limit), whose lists have lengths of their own.

    ``each_k`` and ``final_k`` are expressions of the ask's ``limit``; ``each_k`` is at most ``most``.
    The lists are built once at that length, in order, and each ask takes their beginnings, with the
    scores that lists of its length have. The log is read once whatever the limits are.
    """
    pairs = written(pair_base(impressions), "pairs")
    base = written(
        pairs.groupBy("item_id", "category", "source").agg(
            F.sum("clicks").alias("clicks"), F.sum("shown").alias("shown"), F.max("newest").alias("newest")
        ),
        "items",
    )
    stats = _rolled(base, "item_id")
    prefs = _preferences(pairs).withColumn("_known", F.lit(True))

    def listing(df: DataFrame, order: list[Column], name: str, *keys: str) -> DataFrame:
        placed = df.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        return placed.groupBy(*keys).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("_at", _entry().alias("entry")))), lambda x: x["entry"]).alias(name)
        )

    best = [F.desc("retrieval_score"), F.asc("item_id")]
    newest = recent(stats, most)
    # popular lists are ordered by more than their score, so their rows come with their places
    top = stats.orderBy(*_popular_order()).limit(most).withColumn("_at", F.row_number().over(W.orderBy(*_popular_order())))
    top = popular(stats, most).join(top.select("item_id", "_at"), "item_id")
    popular_list = listing(top, [F.asc("_at")], "l").scalar()
    recent_list = listing(newest, best, "l").scalar()
    fresh_list = listing(newest.withColumn("retrieval_strategy", F.lit("unseen_recent")), best, "l").scalar()

    def attributes(attribute: str, name: str) -> DataFrame:
        # at equal clicks the order goes on by impressions and time, which the list has lost
        rolled = _rolled(base.where(F.col(attribute).isNotNull()), attribute, "item_id")
        places = top_k(rolled, [attribute], _popular_order(), most, "_at").select(F.col(attribute).alias("key"), "item_id", "_at")
        return listing(by_attribute(base, attribute, most).join(places, ["key", "item_id"]), [F.asc("_at")], name, "key")

    own = _unseen_lists(pairs, stats, most, head)
    by_score = "(a, b) -> case when a.retrieval_score > b.retrieval_score then -1 when a.retrieval_score < b.retrieval_score then 1 else 0 end"
    own = own.select("user_id", F.expr(f"array_sort(_own, {by_score})").alias("_own"))
    rows = (
        asks.select("user_id", "limit").distinct()
        .join(prefs.join(own, "user_id", "left"), "user_id", "left")
        .join(attributes("category", "_cat"), F.col("preferred_category") == F.col("key"), "left")
        .drop("key")
        .join(attributes("source", "_src"), F.col("preferred_source") == F.col("key"), "left")
    )
    cut = lambda name, entries: F.slice(entries, 1, each_k).alias(name)
    unseen_list = F.when(F.col("_known"), F.col("_own")).otherwise(fresh_list)
    # the shared lists become columns first, as a subquery may not stand within a transform
    cuts = rows.select(
        "user_id", "limit", cut("_top", popular_list), cut("_new", recent_list), cut("_own", unseen_list),
        cut("_cat", F.col("_cat")), cut("_src", F.col("_src")),
    )
    placed = lambda name: F.transform(  # noqa: E731  newest first: n, n - 1, ... 1
        name, lambda e, i: e.withField("retrieval_score", (F.size(name) - i).cast("double"))
    )
    lists = F.array("_top", placed("_new"), placed("_own"), "_cat", "_src")
    entries = cuts.select("user_id", "limit", F.explode_outer(F.flatten(F.array_compact(lists))).alias("_e"))
    blended = blend(entries.where(F.col("_e").isNotNull()).select("user_id", "limit", "_e.*"), final_k, ["user_id", "limit"])
    return _with_item(blended, item_columns)


def blend(candidates: DataFrame, final_k: int | Column = 50, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """Merge strategies per (user, item): best weighted score, strategy count, last known attributes."""
    place, weight = F.lit(len(STRATEGY_WEIGHTS)), F.lit(1.0)
    for i, (name, value) in enumerate(STRATEGY_WEIGHTS.items()):
        place = F.when(F.col("retrieval_strategy") == name, F.lit(i)).otherwise(place)
        weight = F.when(F.col("retrieval_strategy") == name, F.lit(value)).otherwise(weight)
    scored = candidates.withColumns({"_place": place, "_blended": F.coalesce("retrieval_score", F.lit(0.0)) * weight})
    merged = scored.groupBy(*keys, "item_id").agg(
        F.max("_blended").alias("blended_retrieval_score"),
        F.max("retrieval_score").alias("retrieval_score_raw"),
        F.max("last_seen_time").alias("last_seen_time"),
        last_known(F.col("source"), F.col("_place")).alias("source"),
        last_known(F.col("category"), F.col("_place")).alias("category"),
        # each strategy lists an item once, so rows are distinct strategies
        F.count(F.lit(1)).alias("retrieval_strategy_count"),
    )
    order = [
        F.desc("retrieval_strategy_count"),
        F.desc("blended_retrieval_score"),
        F.desc_nulls_last("last_seen_time"),
        F.asc("item_id"),
    ]
    return top_k(merged, keys, order, final_k, "retrieval_rank")
