"""Every operator as a runnable query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatewright.functions import scalars as S
from slatewright.operators import embeddings, retrieval
from slatewright.operators.axes import leading_axes, packed_rows, projected
from slatewright.operators.groups import latest_row
from slatewright.operators.position import day_level, split_by_time, split_stratified
from slatewright.operators.rerank import rerank_v1, rerank_v2
from slatewright.operators.running import asof_join
from slatewright.plans import features, feed, history, metrics, models, policy, quality
from slatewright.plans.fills import UsualFill, UsualValues
from slatewright.session import configure, fresh_folder, written
from slatewright.sources import bench_tables as B
from slatewright.sources import content as C
from slatewright.sources import online
from slatewright.sources.snapshots import SnapshotStore
from slatewright.sources.tables import with_event_defaults
from slatewright.streaming import events as streams

AS_OF = "2024-02-01 00:00:00"
PAGES_AS_OF = "2024-03-01 00:00:00"
TIE = ("event_id",)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return C.normalize(B.page_records(spark, folder), "arrival")


def backbone(spark: SparkSession, folder: str) -> DataFrame:
    return history.impression_backbone(B.impressions(spark, folder).withColumnRenamed("impression_time", "timestamp"))


def training(spark: SparkSession, folder: str) -> DataFrame:
    return history.training_rows(backbone(spark, folder), TIE)


def embedded(spark: SparkSession, folder: str) -> DataFrame:
    rows, items = training(spark, folder), B.item_vectors(spark, folder)
    shown = B.impressions(spark, folder)
    users = embeddings.user_centroids(shown, items, B.VECTOR_DIMS)
    return embeddings.similarity(rows, items, users, B.VECTOR_DIMS, pairs=shown)


def sim_log(spark: SparkSession, folder: str) -> DataFrame:
    """Impressions as an event log with the user's usual category and source as profile."""
    shown = B.impressions(spark, folder).withColumnRenamed("impression_time", "timestamp")
    prefs = features.click_preferences(B.events(spark, folder, ["click"]), B.content(spark, folder))
    joined = shown.join(prefs, "user_id", "left")
    return joined.withColumns(
        {
            "preferred_category_match": S.matches("category", "preferred_category"),
            "preferred_source_match": S.matches("source", "preferred_source"),
        }
    )


def policy_log(spark: SparkSession, folder: str) -> DataFrame:
    return policy.propensity_log(history.event_priors(sim_log(spark, folder)))


# --- content ---------------------------------------------------------------


@query
def content_normalized(spark, folder):
    return pages(spark, folder).select(
        "item_id", "source", "source_type", "title", "description", "url", "published_at", "category", "content_length"
    )


@query
def content_newest(spark, folder):
    return C.newest(pages(spark, folder), 50).select("item_id", "title", "source", "category", "published_at", "url")


@query
def item_features(spark, folder):
    """Pages of mobile hosts count as undated, so the median age is used."""
    dated = pages(spark, folder).withColumn(
        "published_at", F.when(~F.col("source").startswith("m."), F.col("published_at"))
    )
    return r6(features.item_features(dated, PAGES_AS_OF), "age_hours")


@query
def ingest_stories(spark, folder):
    rows = B.table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        F.when(F.col("url").contains("?"), "comment").otherwise("story").alias("type"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.when(F.col("url").contains("#"), "").otherwise(F.col("url")).alias("url"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("by"),
        (F.lit(1704067200) + F.col("page_id") * 3600).alias("time"),
    )
    as_json = rows.select(F.from_json(F.to_json(F.struct("*")), C.STORY_SCHEMA).alias("s")).select("s.*")
    return C.stories(as_json, AS_OF).select("item_id", "source", "title", "url", "author", "published_at", "category")


@query
def ingest_editorial(spark, folder):
    page = B.table(spark, folder, "pages")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    section = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    result = F.struct(
        F.concat(F.lit("news/"), F.col("page_id").cast("string")).alias("id"),
        title.alias("webTitle"),
        F.col("url").alias("webUrl"),
        F.lit("2024-01-01T00:00:00Z").alias("webPublicationDate"),
        F.when(section != "", section).alias("sectionName"),
        F.struct(
            F.when(F.col("page_id") % 2 == 0, title).alias("headline"),
            F.lit(None).cast("string").alias("trailText"),
            F.regexp_extract("url", "^https?://([^/]+)", 1).alias("byline"),
        ).alias("fields"),
    )
    payload = page.select(F.to_json(F.struct(F.struct(F.array(result).alias("results")).alias("response"))).alias("j"))
    parsed = payload.select(F.from_json("j", C.EDITORIAL_SCHEMA).alias("p")).select("p.*")
    return C.editorial(parsed, AS_OF).select("item_id", "title", "description", "url", "author", "published_at", "category")


@query
def ingest_feed(spark, folder):
    """Every page as the single entry of a feed document of its section."""
    section = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    link = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    docs = B.table(spark, folder, "pages").select(
        F.when(section == "", "other").otherwise(section).alias("feed"),
        F.concat(
            F.lit("<rss><channel><item><title>page "),
            F.col("page_id").cast("string"),
            F.lit("</title><link>"),
            link,
            F.lit("</link><pubDate>Mon, 01 Jan 2024 06:00:00 GMT</pubDate></item></channel></rss>"),
        ).alias("xml"),
    )
    feeds = docs.select(F.col("feed").alias("name"), F.concat(F.lit("cat_"), F.col("feed")).alias("category")).distinct()
    return C.feed_entries(docs, feeds, AS_OF).select("item_id", "source", "title", "url", "published_at", "category")


@query
def event_append(spark, folder):
    """Events as appended rows: defaults filled, ids as text."""
    rows = with_event_defaults(B.events(spark, folder))
    return rows.select(
        "event_id", "timestamp", "user_id", "session_id", "event_type", "item_id", "model_version", "policy_name",
        "device_type", "metadata", "dwell_time",
    )


# --- first-generation features -----------------------------------------------


@query
def context_features(spark, folder):
    return features.context_features(B.events(spark, folder, ["impression"]))


@query
def user_event_pivot(spark, folder):
    return features.event_pivot(B.events(spark, folder))


@query
def user_preferences(spark, folder):
    return features.user_features(B.events(spark, folder), B.content(spark, folder))


@query
def labelled_impressions(spark, folder):
    return features.labelled_impressions(B.events(spark, folder, ["impression", "click"]))


@query
def training_dataset(spark, folder):
    return r6(features.training_dataset(B.events(spark, folder), B.content(spark, folder), AS_OF), "age_hours")


@query
def session_running_counts(spark, folder):
    counted = features.session_counts(B.events(spark, folder), ["timestamp", "event_id"])
    return counted.select("event_id", *features.COUNTED_TYPES.values())


@query
def session_depth(spark, folder):
    return features.session_depth(B.events(spark, folder), ["timestamp", "event_id"]).select("event_id", "session_depth")


@query
def user_rolling_24h(spark, folder):
    rows = features.user_activity_24h(B.events(spark, folder).select("event_id", "user_id", "timestamp", "event_type"))
    return rows.select("event_id", "recent_click_count_24h", "recent_impression_count_24h")


@query
def item_popularity_7d(spark, folder):
    rows = features.item_popularity_7d(B.events(spark, folder).select("event_id", "item_id", "timestamp", "event_type"))
    return rows.select("event_id", "recent_popularity")


@query
def user_average_dwell(spark, folder):
    rows = B.events(spark, folder).select("event_id", "user_id", "timestamp", "dwell_time")
    swept = features.average_dwell(rows, ["timestamp", "event_id"])
    # the nudge keeps exact halves from rounding by representation
    return swept.select("event_id", F.round(F.col("avg_dwell_time") + 1e-9, 6).alias("avg_dwell_time"))


@query
def global_ctr(spark, folder):
    rows = B.events(spark, folder).select("event_id", "timestamp", "event_type")
    swept = features.global_ctr(rows, ["timestamp", "event_id"])
    return swept.select("event_id", "global_ctr")


@query
def pref_category_7d(spark, folder):
    clicks = B.events(spark, folder, ["click"]).join(B.content(spark, folder), "item_id", "left")
    rows = features.with_preferred_7d(B.events(spark, folder, ["impression"]), clicks)
    return rows.select("event_id", "preferred_category_last_7d", "preferred_source_last_7d")


@query
def pref_category_7d_one_user(spark, folder):
    """The same where one user owns the whole log, swept in 16 ranges."""
    alone = lambda df: df.withColumn("user_id", F.lit(0))
    clicks = B.events(spark, folder, ["click"]).join(B.content(spark, folder), "item_id", "left")
    rows = features.with_preferred_7d(alone(B.events(spark, folder, ["impression"])), alone(clicks), ranges=16)
    return rows.select("event_id", "preferred_category_last_7d", "preferred_source_last_7d")


# --- backbone, priors, point in time -------------------------------------------


def _log_input(spark, folder):
    return B.scored_log(spark, folder).select(
        "event_id", "user_id", "session_id", "item_id", F.col("impression_time").alias("timestamp"), "clicked",
        "rank_position", "source", "category", F.col("raw_age_hours").alias("age_hours"),
    )


@query
def impressions_backbone(spark, folder):
    return history.impression_backbone(_log_input(spark, folder)).drop("event_id")


@query
def impressions_numbered(spark, folder):
    """Without event ids rows are numbered over the whole log."""
    rows = _log_input(spark, folder).withColumnRenamed("event_id", "row_key")
    numbered = history.impression_backbone(rows.withColumn("title_length", F.col("row_key")), ["row_key"])
    return numbered.select(F.col("title_length").alias("row_key"), "impression_id")


#: so few rows make a key hot in the queries over ranges
RANGE_ROWS = 500


@query
def impressions_numbered_ranges(spark, folder):
    """The same by a prefix scan over ranges: a day's rows are in many of them."""
    rows = _log_input(spark, folder).withColumnRenamed("event_id", "row_key")
    rows = rows.withColumn("title_length", F.col("row_key"))
    numbered = history.impression_backbone(rows, ["row_key"], RANGE_ROWS)
    return numbered.select(F.col("title_length").alias("row_key"), "impression_id")


@query
def user_prior_ctr(spark, folder):
    rows = B.impressions(spark, folder).select("event_id", "user_id", "impression_time", "clicked")
    return r6(history.priors(rows, "user_id", "user", "impression_time", TIE), "user_ctr_prior").drop("impression_time", "clicked")


@query
def item_prior_ctr(spark, folder):
    rows = B.scored_log(spark, folder).select("event_id", "item_id", "impression_time", "clicked")
    return r6(history.priors(rows, "item_id", "item", "impression_time", TIE), "item_ctr_prior").drop("impression_time", "clicked")


@query
def item_prior_ctr_ranges(spark, folder):
    """Priors of one item that owns the whole log, with whole days of equal times."""
    rows = B.scored_log(spark, folder).select("event_id", F.lit("all").alias("item_id"), "impression_time", "clicked")
    found = history.priors(rows, "item_id", "item", "impression_time", TIE, hot_rows=RANGE_ROWS)
    return found.select("event_id", "item_prev_clicks", "item_prev_impressions", "item_ctr_prior")


@query
def user_prev_attrs(spark, folder):
    return history.user_history(backbone(spark, folder), TIE).select("event_id", "user_prev_category", "user_prev_source")


@query
def pit_user_join(spark, folder):
    """Strictly earlier user features at every save and hide."""
    left = B.events(spark, folder, ["save", "hide"]).select("event_id", "user_id", "timestamp")
    right = history.user_history(backbone(spark, folder), TIE).withColumnRenamed("event_id", "row_id")
    names = ["user_prev_clicks", "user_prev_impressions", "user_ctr_prior", "user_prev_category"]
    joined = asof_join(left, right, "user_id", "timestamp", "feature_timestamp", names, "user_feature_time", ["row_id"], True)
    return r6(joined, "user_ctr_prior")


@query
def pit_user_join_ranges(spark, folder):
    """As-of join where one user owns all rows and times are whole days."""
    day = lambda time: F.date_trunc("day", time)
    left = B.events(spark, folder, ["save", "hide"]).select("event_id", F.lit("all").alias("user_id"), day("timestamp").alias("timestamp"))
    right = B.events(spark, folder, ["click"]).select(
        F.lit("all").alias("user_id"), day("timestamp").alias("click_time"), F.col("event_id").alias("click_id"), "item_id"
    )
    return asof_join(left, right, "user_id", "timestamp", "click_time", ["click_id", "item_id"], "found_at", ["click_id"], hot_rows=RANGE_ROWS)


@query
def pit_training_rows(spark, folder):
    rows = training(spark, folder).select(
        "event_id", "user_prev_clicks", "user_prev_impressions", "user_ctr_prior", "user_prev_category",
        "user_prev_source", "user_feature_time", "item_prev_impressions", "item_prev_clicks", "item_ctr_prior",
        "item_feature_time", "user_item_category_match_v2", "user_item_source_match_v2", "recency_decay",
    )
    return r6(rows, "user_ctr_prior", "item_ctr_prior", "recency_decay")


@query
def temporal_validity(spark, folder):
    return history.temporal_validity(training(spark, folder))


@query
def sim_priors(spark, folder):
    rows = history.event_priors(B.impressions(spark, folder).withColumnRenamed("impression_time", "timestamp"))
    names = ["user_ctr_prior_sim", "item_ctr_prior_sim", "recency_decay_sim"]
    return r6(rows, *names).select(
        "event_id", "user_prev_clicks_sim", "user_prev_impressions_sim", "item_prev_clicks_sim",
        "item_prev_impressions_sim", *names,
    )


# --- online ---------------------------------------------------------------------


@query
def latest_user_snapshot(spark, folder):
    snap = online.user_snapshot(training(spark, folder), list(TIE))
    return r6(snap, "user_ctr_prior").select(
        "user_id", "user_prev_clicks", "user_prev_impressions", "user_ctr_prior", "user_prev_category",
        "user_prev_source", "feature_timestamp",
    )


@query
def latest_item_snapshot(spark, folder):
    """From a log with the simulated names, so every alias fills its target."""
    log = history.event_priors(sim_log(spark, folder))
    return r6(online.item_snapshot(log, list(TIE)), "item_ctr_prior", "item_age_hours").select(
        "item_id", "item_prev_clicks", "item_prev_impressions", "item_ctr_prior", "item_age_hours", "source", "category",
        "feature_timestamp",
    )


@query
def online_payloads(spark, folder):
    return online.materialize(training(spark, folder), AS_OF, list(TIE))


@query
def online_status(spark, folder):
    return online.status(online.materialize(training(spark, folder), AS_OF, list(TIE)), "training rows")


@query
def online_lookup(spark, folder):
    """Payloads read back by key; an unknown key gives nulls."""
    store = online.materialize(training(spark, folder), AS_OF, list(TIE))
    keys = B.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"))
    found = online.lookup(keys, store, "user", "user_prev_clicks double, user_prev_category string", AS_OF)
    return found.select("entity_id", "features.user_prev_clicks", "features.user_prev_category")


@query
def online_overlay(spark, folder):
    rows = training(spark, folder)
    rows = written(rows, "training")
    laid = online.overlay(rows, online.user_snapshot(rows, list(TIE)), online.item_snapshot(rows, list(TIE)))
    return r6(laid, "item_ctr_prior", "recency_decay").select(
        "event_id", "user_prev_clicks", "item_prev_clicks", "item_ctr_prior", "preferred_category_match",
        "user_item_source_match_v2", "recency_decay",
    )


# --- vectors and text --------------------------------------------------------------


@query
def user_embeddings(spark, folder):
    users = embeddings.user_centroids(B.impressions(spark, folder), B.item_vectors(spark, folder), B.VECTOR_DIMS)
    return r6(users.select("user_id", F.posexplode("user_vector").alias("dim", "value")), "value")


@query
def similarity_features(spark, folder):
    names = ["user_item_embedding_cosine", "user_embedding_norm", "item_embedding_norm"]
    return r6(embedded(spark, folder), *names).select("event_id", *names, "embedding_affinity_bucket")


@query
def pseudo_text(spark, folder):
    newest = latest_row(backbone(spark, folder), ["item_id"], "impression_time", ["event_id"])
    return newest.select("item_id", S.pseudo_text(["source", "source_type", "category", "item_age_hours"]).alias("embedding_text"))


@query
def tfidf_terms(spark, folder):
    # a folder's documents may be one file, that is one split
    docs, cores = B.table(spark, folder, "documents"), spark.sparkContext.defaultParallelism
    return r6(embeddings.tfidf(docs, "doc_id", "text", parts=cores), "weight")


@query
def item_svd(spark, folder):
    """Text vectors of the documents; the sign of an axis is arbitrary, so squares are reported."""
    docs = B.table(spark, folder, "documents")
    vectors = embeddings.svd_vectors(embeddings.tfidf(docs, "doc_id", "text"), "doc_id", texts=docs)
    return vectors.select("doc_id", F.transform("item_vector", lambda x: F.round(x * x, 6)).alias("squares"))


@query
def item_svd_gram(spark, folder):
    """Lengths of the documents' vectors and products with the next one's, over a vocabulary of as many terms as axes.

    A decomposition without loss keeps both.
    """
    docs = B.table(spark, folder, "documents").select("doc_id", "text")
    weights = written(embeddings.tfidf(docs, "doc_id", "text", size=embeddings.MAX_DIMS), "weights")
    terms = [r["term"] for r in weights.select("term").distinct().orderBy("term").collect()]  # <= MAX_DIMS
    axes = leading_axes(packed_rows(weights, "doc_id", terms), len(terms), len(terms))
    vectors = written(projected(weights, "doc_id", terms, axes, docs, "v"), "vectors")
    after = vectors.select((F.col("doc_id") - 1).alias("doc_id"), F.col("v").alias("w"))
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    both = vectors.join(after, "doc_id", "left")
    rows = both.select("doc_id", product("v", "v").alias("squared_length"), F.coalesce(product("v", "w"), F.lit(0.0)).alias("next_product"))
    # without a negative zero
    return rows.withColumns({c: F.round(F.col(c), 6) + 0.0 for c in ("squared_length", "next_product")})


@query
def item_text_vectors(spark, folder):
    rows = embeddings.item_embeddings(backbone(spark, folder).withColumn("title_length", F.lit(50)))
    return rows.select("item_id", "source", "source_type", "category", F.size("item_vector").alias("dims"))


# --- retrieval -----------------------------------------------------------------------


_CAND = ["item_id", "last_seen_time", "source", "category", "retrieval_strategy", "retrieval_score"]


@query
def cand_popular(spark, folder):
    return retrieval.popular(retrieval.item_stats(B.scored_log(spark, folder)), 20).select(*_CAND)


@query
def cand_recent(spark, folder):
    return retrieval.recent(retrieval.item_stats(B.scored_log(spark, folder)), 20).select(*_CAND)


@query
def cand_category(spark, folder):
    return retrieval.by_attribute(retrieval.item_base(B.scored_log(spark, folder)), "category", 20)


@query
def cand_source(spark, folder):
    return retrieval.by_attribute(retrieval.item_base(B.scored_log(spark, folder)), "source", 20)


@query
def cand_unseen(spark, folder):
    return retrieval.unseen(B.impressions(spark, folder), 20).select("user_id", *_CAND)


@query
def cand_preferences(spark, folder):
    return retrieval.preferences(B.impressions(spark, folder))


@query
def cand_blended(spark, folder):
    found = retrieval.retrieve(B.impressions(spark, folder), each_k=10, final_k=25)
    return r6(found, "blended_retrieval_score").select(
        "user_id", "item_id", "blended_retrieval_score", "retrieval_score_raw", "retrieval_strategy_count",
        "last_seen_time", "source", "category", "retrieval_rank",
    )


@query
def candidates_per_user(spark, folder):
    return quality.candidates_per_user(retrieval.retrieve(B.impressions(spark, folder), each_k=10, final_k=25))


@query
def candidate_profile(spark, folder):
    found = retrieval.retrieve(B.impressions(spark, folder), each_k=10, final_k=25)
    return quality.value_counts(found, ["category", "source", "retrieval_strategy_count"], 10)


# --- scoring, reranking, feeds -----------------------------------------------------------


@query
def heuristic_scores(spark, folder):
    rows = online.refresh_derived(embedded(spark, folder))
    return r6(feed.score_v2(rows), "model_score").select("event_id", "model_score")


@query
def rerank_freshness_diversity(spark, folder):
    rows = B.scored_log(spark, folder).select(
        "session_id", F.col("event_id").alias("item_id"), "source", "category",
        F.when(F.col("category") != "PROMO", F.col("age_hours")).alias("age_hours"),
        (F.col("score") / 99991.0).alias("model_score"),
    )
    out = rerank_v1(rows, ["session_id"], 5)
    return r6(out, "freshness_bonus", "category_repeat_penalty", "source_repeat_penalty", "final_score").select(
        "session_id", "item_id", "freshness_bonus", "category_repeat_penalty", "source_repeat_penalty", "final_score",
        "final_rank",
    )


@query
def rerank_retrieval_recency(spark, folder):
    rows = B.scored_log(spark, folder).select(
        "session_id", F.col("event_id").alias("item_id"), "source", "category",
        (F.col("score") / 99991.0).alias("model_score"),
        F.col("rank_position").cast("double").alias("blended_retrieval_score"),
        S.recency_decay("age_hours").alias("recency_decay"),
    )
    out = rerank_v2(rows, ["session_id"], 5)
    return r6(out, "final_score").select("session_id", "item_id", "final_score", "rank")


@query
def rerank_bad_scores(spark, folder):
    rows = B.scored_log(spark, folder)
    bad = F.when(F.col("rank_position") % 3 == 0, F.lit(None)).when(F.col("rank_position") % 7 == 0, F.lit(float("nan")))
    rows = rows.select(
        "session_id", F.col("event_id").alias("item_id"), "source", "category",
        bad.otherwise(F.col("score") / 99991.0).alias("model_score"),
        F.col("rank_position").cast("double").alias("blended_retrieval_score"),
        S.recency_decay("age_hours").alias("recency_decay"),
    )
    out = rerank_v2(rows, ["session_id"], 5)
    return r6(out, "final_score").select("session_id", "item_id", "final_score", "rank")


def _first_scorer(frame: DataFrame):
    """A fixed logistic score of the first-generation features."""
    return S.sigmoid(
        F.lit(-1.0)
        + F.lit(0.8) * F.col("preferred_category_match")
        + F.lit(0.5) * F.col("preferred_source_match")
        + F.lit(0.02) * F.col("title_length")
        - F.lit(0.001) * F.col("age_hours")
        + F.lit(0.01) * F.col("recent_click_count")
    )


@query
def rank_feed_v1(spark, folder):
    log, items = B.events(spark, folder), B.content(spark, folder)
    users = features.user_features(log, items)
    ranked = feed.rank_feed_v1(
        users.select("user_id"), items, features.item_features(items, AS_OF), users, AS_OF, _first_scorer, 10, "fixed"
    )
    return r6(ranked, "model_score", "freshness_bonus").select(
        "user_id", "model_version", "item_id", "title", "source", "source_type", "category", "url", "model_score",
        "freshness_bonus", "final_rank",
    )


@query
def rank_feed_requests(spark, folder):
    """A request per user, with limits from -4 to 55, and of users without any event."""
    log, items = B.events(spark, folder), B.content(spark, folder)
    users = written(features.user_features(log, items), "users")
    asking = users.select("user_id")
    unknown = asking.where(F.col("user_id") % 50 == 0).select((F.col("user_id") + 1_000_000).alias("user_id"))
    session = F.concat(F.lit("r"), F.col("user_id").cast("string"))
    limit = (F.col("user_id") % 60 - 4).cast("int")
    requests = asking.unionByName(unknown).select("user_id", session.alias("session_id"), limit.alias("limit"))
    largest = feed.rank_feed_v1(
        requests.select("user_id"), items, features.item_features(items, AS_OF), users, AS_OF, _first_scorer, feed.MAX_LIMIT, "fixed"
    )
    return r6(feed.serve_v1(largest, requests), "model_score").select(
        "user_id", "session_id", "limit", "status", "item_id", "model_score", "final_rank"
    )


@query
def rank_feed_v2(spark, folder):
    rows = written(embedded(spark, folder), "training")
    ranked = feed.rank_feed_v2(B.impressions(spark, folder), rows, limit=10, tie=TIE)
    return r6(ranked, "blended_retrieval_score", "model_score", "final_score")


@query
def rank_feed_requests_v2(spark, folder):
    """A request per user, with limits from -4 to 55, answered by the second generation in one plan."""
    rows, shown = written(embedded(spark, folder), "training"), B.impressions(spark, folder)
    asking = shown.select("user_id").distinct()
    session = F.concat(F.lit("r"), F.col("user_id").cast("string"))
    requests = asking.select("user_id", session.alias("session_id"), (F.col("user_id") % 60 - 4).cast("int").alias("limit"))
    served = feed.serve_v2(shown, rows, requests, tie=TIE)
    return r6(served, "blended_retrieval_score", "model_score", "final_score")


@query
def rank_feed_v2_online(spark, folder):
    """The feed with online user and item values laid over the offline ones."""
    rows = written(embedded(spark, folder), "training")
    ranked = feed.rank_feed_v2(
        B.impressions(spark, folder),
        rows,
        limit=10,
        tie=TIE,
        online_users=online.user_snapshot(rows, list(TIE)),
        online_items=online.item_snapshot(rows, list(TIE)),
    )
    return r6(ranked, "blended_retrieval_score", "model_score", "final_score")


# --- policies and metrics -------------------------------------------------------------------


@query
def policy_scores(spark, folder):
    names = ["logged_policy_score", "logged_propensity", "target_policy_score", "target_propensity"]
    return r6(policy_log(spark, folder), *names).select("event_id", *names)


@query
def click_probability(spark, folder):
    rows = sim_log(spark, folder)
    later = S.click_probability(policy.click_terms(rows))
    earlier = S.click_probability(policy.click_terms(rows), S.CLICK_LOGIT_V2)
    return r6(rows.withColumns({"click_probability": later, "click_probability_v2": earlier}), "click_probability", "click_probability_v2").select(
        "event_id", "click_probability", "click_probability_v2"
    )


@query
def weighted_slate(spark, folder):
    """Ten of the items each user was shown, drawn by weight."""
    rows = latest_row(sim_log(spark, folder), ["user_id", "item_id"], "timestamp", ["event_id"])
    return r6(policy.sampled_slates(rows, 10), "weight").select("user_id", "item_id", "weight", "rank_position")


@query
def ranking_report(spark, folder):
    return r6(metrics.ranking_report(B.scored_log(spark, folder), "score", 5), *metrics.RANKING)


@query
def ranking_by_session(spark, folder):
    return r6(metrics.session_ranking(B.scored_log(spark, folder), "score", 5), *metrics.RANKING)


@query
def feed_quality_report(spark, folder):
    return r6(metrics.feed_quality_report(B.scored_log(spark, folder), "score", 5), *metrics.FEED_QUALITY)


@query
def policy_delta(spark, folder):
    return r6(metrics.policy_delta(written(policy_log(spark, folder), "policy"), 5), "logged", "target", "delta")


@query
def counterfactual_report(spark, folder):
    report = metrics.counterfactual_report(policy_log(spark, folder))
    return r6(report, *[c for c in report.columns if c != "n_rows"])


@query
def ips_single(spark, folder):
    return r6(metrics.single_policy_report(policy_log(spark, folder), "clicked", "logged_propensity"), "ips", "snips")


@query
def binary_metrics(spark, folder):
    rows = B.scored_log(spark, folder).withColumn("p", F.col("score") / 105000.0)
    return metrics.binary_metrics(rows, "p")


@query
def binary_metrics_crowded(spark, folder):
    """All scores within 1e-9, swept by ranges of scores."""
    rows = B.scored_log(spark, folder).withColumn("p", 0.5 + F.col("score") / 105000.0 * 1e-9)
    return metrics.binary_metrics(rows, "p", hot_rows=RANGE_ROWS)


@query
def split_time(spark, folder):
    rows = written(B.scored_log(spark, folder).select("event_id", "impression_time"), "log")
    return split_by_time(rows, "impression_time", ["event_id"], levels=day_level("impression_time")).select("event_id", "split")


@query
def split_time_events(spark, folder):
    rows = B.events(spark, folder).select("event_id", "timestamp")
    return split_by_time(rows, "timestamp", ["event_id"]).select("event_id", "split")


@query
def split_random(spark, folder):
    rows = written(B.scored_log(spark, folder).select("event_id", "clicked"), "log")
    return split_stratified(rows, "clicked", ["event_id"])


# --- models ------------------------------------------------------------------------------------


def _first_split(spark, folder):
    rows = written(features.training_dataset(B.events(spark, folder), B.content(spark, folder), AS_OF), "training")
    return split_stratified(rows, "clicked", ["event_id"])


def _second_split(spark, folder):
    return split_by_time(written(embedded(spark, folder), "training"), "impression_time", ["event_id"])


@query
def usual_fills(spark, folder):
    """Fills fitted on the first half of January, saved, loaded and applied to all raw impressions.

    Ages before publication count as missing, as does the source of such a row.
    """
    early = F.col("age_hours") < 0
    rows = B.impressions(spark, folder).select(
        "event_id", "impression_time", "dwell_time", "category",
        F.when(~early, F.col("age_hours")).cast("string").alias("age_hours"), F.when(~early, F.col("source")).alias("source"),
    )
    rows = written(rows, "raw")
    stage = UsualValues(numeric=["age_hours", "dwell_time"], categorical=["source", "category"])
    folder_of_stage = fresh_folder(spark, "fills")
    stage.fit(rows.where(F.col("impression_time") < "2024-01-15")).write().save(folder_of_stage)
    filled = UsualFill.load(folder_of_stage).transform(rows)
    return r6(filled, "age_hours_filled", "dwell_time_filled").select(
        "event_id", "age_hours_filled", "dwell_time_filled", "source_known", "category_known"
    )


@query
def train_first(spark, folder):
    return models.train_v1(_first_split(spark, folder))[1]


@query
def train_second(spark, folder):
    return models.train_v2(_second_split(spark, folder))[1]


@query
def train_boosted(spark, folder):
    return _scored_by(spark, folder, "gbt")


def _scored_by(spark, folder, name):
    """All parts, scored by a model fitted on the training part."""
    rows = _second_split(spark, folder)
    fitted = models.fit_v2(rows.where(F.col("split") == "train"), name)
    numeric = [c for c in feed.NUMERIC_FEATURES if c in rows.columns]
    text = [c for c in feed.CATEGORICAL_FEATURES if c in rows.columns]
    return models.predict(fitted, models.fill_constant(rows, numeric, text)).select("event_id", "split", "clicked", "model_score")


@query
def train_forest(spark, folder):
    return _scored_by(spark, folder, "forest")


@query
def train_simulated(spark, folder):
    rows = split_by_time(written(history.event_priors(sim_log(spark, folder)), "training"), "timestamp", ["event_id"])
    return models.train_simulated(rows)[1]


@query
def train_simulated_second(spark, folder):
    """The model of fifteen inputs, not scaled."""
    rows = split_by_time(written(history.event_priors(sim_log(spark, folder)), "training"), "timestamp", ["event_id"])
    return models.train_simulated(rows, features=models.SIM_V2, standardize=False)[1]


# --- checks ------------------------------------------------------------------------------------


@query
def quality_content(spark, folder):
    return quality.content_report(B.page_records(spark, folder))


@query
def content_by_source(spark, folder):
    return quality.group_counts(pages(spark, folder), "source_type", "source")


@query
def quality_events(spark, folder):
    return quality.group_counts(B.events(spark, folder), "user_id", "event_type")


@query
def event_types(spark, folder):
    return quality.group_counts(B.events(spark, folder), "event_type")


@query
def newest_events(spark, folder):
    return quality.newest_events(B.events(spark, folder), 20)


@query
def profile_nulls(spark, folder):
    rows = B.table(spark, folder, "documents").join(B.table(spark, folder, "labels"), "doc_id", "left")
    return quality.null_counts(rows)


@query
def profile_values(spark, folder):
    return quality.value_counts(B.scored_log(spark, folder), ["source", "category"])


@query
def profile_log(spark, folder):
    return quality.profile(B.impressions(spark, folder))


# --- streams -------------------------------------------------------------------------------------


EVENT_FILE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def arrivals(spark: SparkSession, folder: str, parts: int = 3, twice: bool = False) -> list[DataFrame]:
    """The event log as it lands, part after part; the last part is a mark, a view and a click long after the log.

    A quarter of the rows come up to 59 minutes late, so some land a part later, within the
    watermark. ``twice`` delivers every row again half an hour on. The mark has no event_id and no
    user; it moves the watermark past the log, so that every window of the log closes.
    """
    log = B.table(spark, folder, "events").select(*EVENT_FILE.names)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = log.agg(F.min(micros), F.max(micros)).first()
    first, last = first or 0, last or 0
    late = F.when(F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0, 59).otherwise(0)
    rows = log.withColumn("minutes", F.explode(F.array(late, F.lit(30))) if twice else late)
    share = (micros + F.col("minutes").cast("bigint") * 60_000_000 - first) * parts / (last - first + 1)
    rows = rows.withColumn("part", F.coalesce(F.least(F.floor(share), F.lit(parts - 1)), F.lit(0)))
    mark = spark.createDataFrame([(None, None, None, "view", None, None), (None, None, None, "click", None, None)], EVENT_FILE)
    end = F.timestamp_micros(F.lit(last)) + F.expr("interval 30 days")
    mark = mark.withColumn("ts", end.cast("timestamp_ntz"))
    return [rows.where(F.col("part") == k).drop("minutes", "part") for k in range(parts)] + [mark]


def drained(spark: SparkSession, folder: str, name: str, build, twice: bool = False) -> DataFrame:
    """Run a stream over each part of the log as it lands, and read what it wrote, in a fresh shared folder."""
    scratch = fresh_folder(spark, name)
    for part in arrivals(spark, folder, twice=twice):
        part.write.mode("append").parquet(f"{scratch}/landing")
        rows = build(B.as_events(spark.readStream.schema(EVENT_FILE).parquet(f"{scratch}/landing")))
        streams.write_stream(rows, f"{scratch}/out", f"{scratch}/state").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{scratch}/out")


@query
def stream_dedupe(spark, folder):
    """Every event delivered twice; each is kept once."""
    kept = drained(spark, folder, "dedupe", streams.deduplicated, twice=True).where(F.col("user_id").isNotNull())
    return kept.select("event_id", "user_id", "event_type", "timestamp")


@query
def stream_counts(spark, folder):
    """Hourly counts of all windows of the log."""
    return drained(spark, folder, "counts", streams.activity)


@query
def stream_sessions(spark, folder):
    return drained(spark, folder, "sessions", lambda rows: streams.sessions(rows, "12 hours"))


@query
def stream_labels(spark, folder):
    """Impressions, and whether a click follows within two days."""
    labelled = drained(spark, folder, "labels", lambda rows: streams.attributed(rows, "2 days"))
    return streams.one_per_impression(labelled).select("event_id", "user_id", "session_id", "item_id", "clicked")


@query
def stream_snapshot(spark, folder):
    """User snapshots kept by a stream of impressions that land in several parts, with late rows."""
    scratch = fresh_folder(spark, "snapshot")
    for part in arrivals(spark, folder):
        part.write.mode("append").parquet(f"{scratch}/landing")
        shown = B.as_events(spark.readStream.schema(EVENT_FILE).parquet(f"{scratch}/landing"))
        shown = shown.where(F.col("event_type").isin("impression", "click"))
        rows = shown.select("event_id", "timestamp", "user_id", "item_id", F.col("event_type").alias("preferred_category"))
        streams.keep_snapshot(rows, f"{scratch}/store", f"{scratch}/state", ["event_id"]).awaitTermination()
    store = SnapshotStore(spark, f"{scratch}/store").read()
    return store.where(F.col("entity_type") == "user").select(
        F.col("entity_id").cast("long").alias("user_id"),
        F.get_json_object("payload", "$.user_prev_category").alias("user_prev_category"),
        "feature_timestamp",
    )
