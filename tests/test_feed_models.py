import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from slatewright.operators import axes, embeddings
from slatewright.operators.axes import leading_axes, packed_rows
from slatewright.operators.sampling import weighted_sample
from slatewright.plans import feed, models, queries
from slatewright.plans.fills import UsualFill, UsualValues
from slatewright.plans.metrics import binary_metrics
from slatewright.sources import bench_tables as B


def test_feed_limits_and_requests(spark, folder):
    shown, rows = B.impressions(spark, folder), queries.training(spark, folder)
    requests = spark.createDataFrame([(1, "a", 3), (2, "b", 5), (10**9, "ghost", 5), (3, "c", 0), (3, "c", 51)], "user_id long, session_id string, limit int")
    got = feed.serve_v2(shown, rows, requests, tie=("event_id",)).collect()
    bad = [r for r in got if r["status"] == "invalid limit"]
    assert [(r["session_id"], r["item_id"]) for r in bad] == [("c", None)] * 2
    ranks = {}
    for r in got:
        if r in bad:
            continue
        ranks.setdefault(r["session_id"], []).append(r["rank"])
        assert r["returned_count"] == (3 if r["session_id"] == "a" else 5)
    assert {s: sorted(v) for s, v in ranks.items()} == {"a": [1, 2, 3], "b": [1, 2, 3, 4, 5], "ghost": [1, 2, 3, 4, 5]}
    with pytest.raises(ValueError):
        feed.rank_feed_v2(shown, rows, limit=51)


def test_svd_keeps_the_gram_matrix(spark):
    texts = [(i, t) for i, t in enumerate(["red apple pie", "green apple tart", "blue sky above", "sky above apple", "pie"])]
    weights = embeddings.tfidf(spark.createDataFrame(texts, "id int, text string"), "id", "text")
    vectors = {r["id"]: np.array(r["item_vector"]) for r in embeddings.svd_vectors(weights, "id", 16).collect()}
    terms = sorted({r["term"] for r in weights.collect()})
    matrix = np.zeros((5, len(terms)))
    for r in weights.collect():
        matrix[r["id"], terms.index(r["term"])] = r["weight"]
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    best = (u[:, :4] * s[:4]) @ (u[:, :4] * s[:4]).T
    got = np.array([[vectors[i] @ vectors[j] for j in range(5)] for i in range(5)])
    assert len(vectors[0]) == 4 and np.allclose(got, best, atol=1e-8)


def test_svd_gives_texts_without_terms_a_zero_vector(spark):
    texts = spark.createDataFrame([(0, "red apple"), (1, "green apple"), (2, None), (3, "")], "id int, text string")
    weights = embeddings.tfidf(texts, "id", "text")
    got = {r["id"]: r["item_vector"] for r in embeddings.svd_vectors(weights, "id", 16, texts).collect()}
    assert set(got) == {0, 1, 2, 3} and {len(v) for v in got.values()} == {3}
    assert got[2] == got[3] == [0.0] * 3 and any(got[0])
    none = embeddings.svd_vectors(weights.where("false"), "id", 16, texts).collect()
    assert [r["item_vector"] for r in none] == [[0.0]] * 4


def test_leading_axes_equal_the_exact_ones(spark):
    rng = np.random.default_rng(1)
    exact = rng.standard_normal((400, 120)) * 0.8 ** np.arange(120)
    exact[rng.random((400, 120)) < 0.7] = 0
    exact[7] = 0
    entries = [(int(i), f"t{j:03d}", float(exact[i, j])) for i, j in zip(*np.nonzero(exact))]
    weights = spark.createDataFrame(entries, "id int, term string, weight double").repartition(5)
    terms = [f"t{j:03d}" for j in range(120)]
    rows = packed_rows(weights, "id", terms)
    got = leading_axes(rows, 120, 6)
    left, values, right = np.linalg.svd(exact, full_matrices=False)
    assert np.allclose(got.T @ got, np.eye(6), atol=1e-10)
    best = (left[:, :6] * values[:6]) @ (left[:, :6] * values[:6]).T
    assert np.allclose((exact @ got) @ (exact @ got).T, best, atol=1e-6 * values[0] ** 2)
    assert np.allclose(np.linalg.norm(exact @ got, axis=0), values[:6], rtol=1e-9)
    assert np.allclose(got, leading_axes(rows, 120, 6), atol=1e-8)  # seeded


def test_rounds_over_few_columns_read_the_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(2)
    exact = rng.standard_normal((700, 90)) * 0.9 ** np.arange(90)
    exact[rng.random((700, 90)) < 0.8] = 0
    entries = [(int(i), f"t{j:03d}", float(exact[i, j])) for i, j in zip(*np.nonzero(exact))]
    weights = spark.createDataFrame(entries, "id int, term string, weight double").repartition(3)
    rows, passes, round_ = packed_rows(weights, "id", [f"t{j:03d}" for j in range(90)]), [], axes._round
    monkeypatch.setattr(axes, "_round", lambda *given: passes.append(1) or round_(*given))
    got = leading_axes(rows, 90, 5)
    assert not passes
    assert np.allclose(axes._gram(rows, 90), exact.T @ exact, atol=1e-9)
    monkeypatch.setattr(axes, "GRAM_COLUMNS", 89)
    assert np.allclose(got, leading_axes(rows, 90, 5), atol=1e-7) and len(passes) > 1


def test_usual_values(spark, tmp_path):
    odd = [(1, "1", "b"), (2, "x", None), (3, None, "a"), (4, "NaN", "a"), (5, "4", "b"), (6, "2.5", "c"), (7, "100", None), (8, "inf", None)]
    rows = spark.createDataFrame(odd, "id int, n string, t string").withColumns({"none": F.lit(None).cast("double"), "void": F.lit(None).cast("string")})
    stage = UsualValues(numeric=["n", "none"], categorical=["t", "void"])
    fitted = stage.fit(rows)
    fitted.write().save(str(tmp_path / "fill"))
    for model in (fitted, UsualFill.load(str(tmp_path / "fill"))):
        got = {r["id"]: (r["n_filled"], r["none_filled"], r["t_known"], r["void_known"]) for r in model.transform(rows).collect()}
        assert {got[i][0] for i in (2, 3, 4, 8)} == {3.25} and got[7][0] == 100.0
        assert {r[1] for r in got.values()} == {0.0} and {r[3] for r in got.values()} == {"unknown"}
        assert [got[i][2] for i in (1, 2, 6, 7)] == ["b", "a", "c", "a"]
    empty = stage.fit(rows.where("false")).transform(rows).where("id = 3").first()
    assert (empty["n_filled"], empty["t_known"]) == (0.0, "a")


def test_centroid_falls_back_to_all_impressions(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "item_id int, item_vector array<double>")
    log = spark.createDataFrame([("u", 1, 0), ("u", 2, 0), ("v", 9, 0)], "user_id string, item_id int, clicked int")
    got = {r["user_id"]: r["user_vector"] for r in embeddings.user_centroids(log, items, 2).collect()}
    assert got == {"u": [0.5, 0.5], "v": [0.0, 0.0]}
    clicked = log.withColumn("clicked", (F.col("item_id") == 2).cast("int"))
    assert {r["user_id"]: r["user_vector"] for r in embeddings.user_centroids(clicked, items, 2).collect()} == {"u": [0.0, 1.0]}
    row = embeddings.similarity(log.where("item_id = 9"), items, embeddings.user_centroids(log, items, 2), 2).first()
    assert row["user_item_embedding_cosine"] == 0 and row["embedding_affinity_bucket"] == "low"


def test_weighted_sample_follows_the_weights(spark):
    frame = spark.range(4000).select((F.col("id") % 1000).alias("g"), F.floor(F.col("id") / 1000).alias("i")).withColumn(
        "w", F.when(F.col("i") == 0, 7.0).otherwise(1.0)
    )
    first = weighted_sample(frame, ["g"], "w", ["i"], 1)
    assert 650 <= first.where("i = 0").count() <= 750
    assert weighted_sample(frame, ["g"], "w", ["i"], 9).groupBy("g").count().where("count != 4").count() == 0


def test_models_train_score_save_and_guard(spark, tmp_path):
    rows = spark.range(300).select(
        F.col("id").alias("event_id"),
        (F.col("id") % 3 == 0).cast("int").alias("clicked"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 3).cast("double")).alias("age_hours"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("source"),
    )
    model = models.fit_v1(rows, "logistic")
    models.save(model, str(tmp_path), "logistic")
    scored = models.predict(models.load(str(tmp_path), "logistic"), rows)
    assert binary_metrics(scored, "model_score").first()["auc"] > 0.8
    # a loaded model takes the raw rows, missing values included, and scores them as the fitted one
    by_id = lambda df: {r["event_id"]: r["model_score"] for r in df.collect()}
    assert by_id(scored) == by_id(models.predict(model, rows)) and scored.columns == [*rows.columns, "model_score"]
    assert models.predict(model, rows.where("event_id = 1").withColumn("source", F.lit("never seen"))).count() == 1
    with pytest.raises(models.NotTrainable):
        models.fit_v1(rows.where("clicked = 0"))
    with pytest.raises(ValueError):
        models.load(str(tmp_path), "other")
    assert not feed.usable(model, rows.drop("source")) and feed.usable(model, rows)
    fallback = feed.score_v2(rows.drop("source").withColumn("item_ctr_prior", F.lit(1.0)), model)
    assert fallback.first()["model_score"] == pytest.approx(0.35)


def test_boosted_trees_get_even_parts_and_the_inputs_that_vary(spark, tmp_path, monkeypatch):
    rows = spark.range(600).select(
        F.col("id").alias("event_id"), (F.col("id") % 7 < 3).cast("int").alias("clicked"), (F.col("id") % 7).alias("hour"),
        (F.col("id") % 24).alias("rank_position"), F.lit(0).alias("recent_click_count"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("all").alias("policy_name"),
    ).coalesce(1)
    seen = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: (seen.append((df.rdd.getNumPartitions(), self.getFeaturesCol())), fit(self, df))[1])
    monkeypatch.setattr(models, "LEAST_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    model = models.fit_v2(rows, "gbt", maxIter=3)
    assert seen == [(cores, "varying_features")]
    # two numbers and three sources; the constant number, the constant text and unseen values are left out
    assert model.stages[-2].getIndices() == [0, 1, 3, 4, 5] and model.stages[-1].numFeatures == 5
    # the same trees as with all features
    constant = rows.withColumns({"hour": F.lit(1), "rank_position": F.lit(2), "source": F.lit("s")})
    assert models.fit_v2(constant, "gbt", maxIter=1).stages[-1].numFeatures == 1
    monkeypatch.setattr(models, "varying", lambda df: list(range(df.schema["features"].metadata["ml_attr"]["num_attrs"])))
    whole = models.fit_v2(rows, "gbt", maxIter=3)
    assert whole.stages[-1].numFeatures == 9
    by_id = lambda df: {r["event_id"]: r["model_score"] for r in df.collect()}
    ready = models.fill_constant(rows, ["hour", "rank_position", "recent_click_count"], ["source", "policy_name"])
    assert by_id(models.predict(model, ready)) == by_id(models.predict(whole, ready))
    models.save(model, str(tmp_path), "gbt")
    assert by_id(models.predict(models.load(str(tmp_path), "gbt"), ready)) == by_id(models.predict(model, ready))
    assert [models.even_parts(n, 12) for n in (0, 600, 119_000, 121_000, 6_000_000, 6_000_001)] == [1, 6, 12, 12, 12, 24]
