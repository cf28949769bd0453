"""Text weights, item vectors, user centroids and similarity features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.functions import vectors as V
from slatewright.operators.axes import leading_axes, packed_rows, projected
from slatewright.operators.groups import latest_row
from slatewright.session import written

# fixed value: a token is a run of at least two letters, digits or underscores
TOKEN = r"[\p{L}\p{N}_]{2,}"
VOCABULARY = 500
MAX_DIMS = 16


def _terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """All unigrams and bigrams of every text, one row each."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)

    def with_pairs(t):
        rest = F.greatest(F.size(t) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(t, F.lit(1), rest), F.slice(t, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(t, pairs)

    # the one-element array binds the tokens, so the text is matched once
    both = F.get(F.transform(F.array(tokens), with_pairs), F.lit(0))
    # the outer form adds no emptiness test, which would match the text a second time
    return df.select(key, F.explode_outer(both).alias("term")).where(F.col("term").isNotNull())


def vocabulary(terms: DataFrame, size: int = VOCABULARY) -> DataFrame:
    """The ``size`` most frequent terms (alphabetical among equals), at most ``size`` rows."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("_freq")).orderBy(F.desc("_freq"), F.asc("term")).limit(size)


def tfidf(df: DataFrame, key: str, text: str, size: int = VOCABULARY, parts: int | None = None) -> DataFrame:
    """(key, term, weight): tf * (ln((1+n)/(1+df)) + 1), rows scaled to length 1.

    ``parts`` deals the texts anew, for an input of fewer splits than cores; it costs a shuffle of them.
    """
    texts = df.select(key, text)
    terms = _terms(texts.repartition(parts, key) if parts else texts, key, text)
    vocab = F.broadcast(vocabulary(terms, size).select("term"))
    # read for the document frequencies and for the weights
    tf = written(terms.join(vocab, "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("_tf")), "tf")
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = tf.groupBy("term").agg(
        (F.log((n + F.lit(1.0)) / (F.count(F.lit(1)) + F.lit(1.0))) + F.lit(1.0)).alias("_idf")
    )
    weighted = tf.join(F.broadcast(idf), "term").withColumn("_w", F.col("_tf") * F.col("_idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(key)))
    return weighted.select(key, "term", (F.col("_w") / length).alias("weight"))


def svd_vectors(weights: DataFrame, key: str, dims: int = MAX_DIMS, texts: DataFrame | None = None) -> DataFrame:
    """Truncated SVD of the (key x term) matrix: (key, vector of <= dims).

    The axes come from sparse rows (see :mod:`slatewright.operators.axes`). ``texts`` holds the
    keys of all texts: those without a term of the vocabulary get a zero vector.
    """
    texts = weights.select(key).distinct() if texts is None else texts.select(key)
    vocab = [r["term"] for r in weights.select("term").distinct().orderBy("term").collect()]  # <= vocabulary size
    if not vocab:
        return texts.withColumn("item_vector", F.array(F.lit(0.0)))
    d = max(1, min(dims, texts.count() - 1, len(vocab) - 1))
    axes = leading_axes(packed_rows(weights, key, vocab), len(vocab), d)
    return projected(weights, key, vocab, axes, texts, "item_vector")


def item_embeddings(
    impressions: DataFrame, text: str | None = None, dims: int = MAX_DIMS, tie: Sequence[str] = ("event_id",)
) -> DataFrame:
    """One row per item (newest snapshot, of equal times the last by ``tie``): metadata and its text vector.

    The text defaults to the metadata rendered as words.
    """
    newest = latest_row(impressions, ["item_id"], "impression_time", list(tie))
    body = S.pseudo_text(newest.columns) if text is None else F.coalesce(text, F.lit("unknown"))
    items = newest.withColumn("embedding_text", body)
    vectors = svd_vectors(tfidf(items, "item_id", "embedding_text"), "item_id", dims, items)
    meta = [c for c in ("source", "source_type", "category") if c in items.columns]
    return items.select("item_id", *meta).join(vectors, "item_id", "left")


def user_centroids(impressions: DataFrame, items: DataFrame, dims: int) -> DataFrame:
    """Mean vector of the items each user clicked; with no click anywhere, of all items shown.
    An item without a vector counts as the zero vector."""
    any_click = impressions.agg(F.coalesce(F.max("clicked"), F.lit(0)).alias("c")).scalar()
    used = impressions.where((F.col("clicked") == 1) | (any_click == 0)).select("user_id", "item_id")
    # the same item clicked twice by a user needs its vector once, weighted
    counted = used.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(items.select("item_id", "item_vector"), "item_id", "left")
    total = F.sum("_n")
    return joined.groupBy("user_id").agg(
        F.array(
            *[
                F.coalesce(F.sum(F.col("_n") * F.get("item_vector", F.lit(j))), F.lit(0.0)) / total
                for j in range(dims)
            ]
        ).alias("user_vector")
    )


def similarity(
    rows: DataFrame, items: DataFrame, users: DataFrame, dims: int, pairs: DataFrame | None = None
) -> DataFrame:
    """Append cosine, both norms and the affinity bucket.

    Norms are taken on the small tables and the product once per distinct
    (user, item) pair, so vectors never travel with the log. ``pairs`` is a cheaper
    frame with the same (user_id, item_id) values.
    """
    item_side = items.select("item_id", V.aligned(F.col("item_vector"), dims).alias("_iv")).withColumn(
        "item_embedding_norm", V.norm(F.col("_iv"))
    )
    user_side = users.select("user_id", V.aligned(F.col("user_vector"), dims).alias("_uv")).withColumn(
        "user_embedding_norm", V.norm(F.col("_uv"))
    )
    pairs = (
        (rows if pairs is None else pairs).select("user_id", "item_id").distinct().join(item_side, "item_id", "left").join(user_side, "user_id", "left")
    )
    zero = F.lit(0.0)
    norms = pairs.withColumns({c: F.coalesce(c, zero) for c in ("item_embedding_norm", "user_embedding_norm")})
    product = F.coalesce(V.dot(F.col("_uv"), F.col("_iv")), zero)
    cos = V.cosine(product, F.col("user_embedding_norm"), F.col("item_embedding_norm"))
    facts = norms.select(
        "user_id", "item_id", cos.alias("user_item_embedding_cosine"), "user_embedding_norm", "item_embedding_norm"
    ).withColumn("embedding_affinity_bucket", V.affinity_bucket(F.col("user_item_embedding_cosine")))
    return rows.join(facts, ["user_id", "item_id"], "left")
