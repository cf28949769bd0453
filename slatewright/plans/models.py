"""Training, scoring and evaluation of click models with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.plans.feed import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from slatewright.plans.fills import UsualValues
from slatewright.plans.metrics import binary_metrics, feed_quality_report, ranking_report
from slatewright.schemas import existing

# fixed values: inputs of the first-generation ranker
V1_NUMERIC = [
    "age_hours", "title_length", "description_length", "hour_published", "weekday_published",
    "recent_impression_count", "recent_click_count", "recent_save_count", "recent_hide_count", "hour_of_day",
    "weekday", "is_weekend", "preferred_source_match", "preferred_category_match",
]
V1_CATEGORICAL = ["source", "source_type", "category", "preferred_source", "preferred_category"]

# fixed values: inputs of the two models on simulated logs
SIM_V3 = [
    "rank_position", "age_hours", "title_length", "description_length", "recent_click_count",
    "recent_impression_count", "recent_save_count", "recent_hide_count", "user_prev_clicks_sim",
    "user_prev_impressions_sim", "user_ctr_prior_sim", "item_prev_clicks_sim", "item_prev_impressions_sim",
    "item_ctr_prior_sim", "preferred_category_match", "preferred_source_match", "recency_decay_sim",
]
SIM_V2 = [c for c in SIM_V3 if c not in ("recent_save_count", "recent_hide_count")]

# a tree model has one bin per category value at most this many
MAX_BINS = 128

# rows of a task in a pass over the training rows: at least (a pass costs more than they do), at most (they are kept in memory)
LEAST_ROWS, MOST_ROWS = 10_000, 500_000


class NotTrainable(ValueError):
    """Empty data or a single label."""


def check_trainable(df: DataFrame, label: str = "clicked") -> int:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    if row["n"] == 0:
        raise NotTrainable("dataset is empty")
    if row["lo"] == row["hi"]:
        raise NotTrainable("not enough label diversity")
    return row["n"]


def fill_constant(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return df.withColumns({**{c: S.number(c) for c in numeric}, **{c: S.known(c) for c in categorical}})


def _encode(categorical: Sequence[str], suffix: str = "") -> list:
    """One-hot of the known values; an unseen value is all zeros. Inputs are the names with ``suffix``."""
    if not categorical:
        return []
    return [
        StringIndexer(
            inputCols=[f"{c}{suffix}" for c in categorical], outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep"
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categorical],
            outputCols=[f"{c}_hot" for c in categorical],
            dropLast=True,
            handleInvalid="keep",
        ),
    ]


def preprocess_v1(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Median for missing numbers, most frequent value for missing text, one-hot text."""
    return [
        UsualValues(numeric=list(numeric), categorical=list(categorical)),
        *_encode(categorical, "_known"),
        VectorAssembler(
            inputCols=[*[f"{c}_filled" for c in numeric], *[f"{c}_hot" for c in categorical]],
            outputCol="features",
        ),
    ]


def preprocess_v2(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Standardised numbers and one-hot text."""
    return [
        VectorAssembler(inputCols=list(numeric), outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        *_encode(categorical),
        VectorAssembler(inputCols=["_scaled", *[f"{c}_hot" for c in categorical]], outputCol="features"),
    ]


def classifier(name: str, n: int, label: str = "clicked", max_iter: int = 1000, **given):
    """logistic (L2, C = 1), gbt (boosted trees) or forest."""
    if name == "logistic":
        return LogisticRegression(
            labelCol=label, maxIter=max_iter, regParam=1.0 / n, elasticNetParam=0.0, standardization=False
        )
    if name == "gbt":
        options = {"maxIter": 100, "stepSize": 0.05, "maxDepth": 4, "minInstancesPerNode": 2, **given}
        return GBTClassifier(labelCol=label, seed=42, maxBins=MAX_BINS, **options)
    if name == "forest":
        options = {"numTrees": 100, "maxDepth": 8, **given}
        return RandomForestClassifier(labelCol=label, seed=42, maxBins=MAX_BINS, **options)
    raise ValueError(f"unsupported model name: {name}")


def even_parts(n: int, cores: int) -> int:
    """Partitions of ``n`` rows that trees pass over again and again: as many for each core, so that no core waits."""
    if n <= cores * LEAST_ROWS:
        return max(1, -(-n // LEAST_ROWS))
    return cores * -(-n // (cores * MOST_ROWS))


def varying(rows: DataFrame) -> list[int]:
    """Entries of the features that have more than one value; the first if none has."""
    found = rows.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("s")).first()["s"]
    return [k for k, (lo, hi) in enumerate(zip(found["min"], found["max"])) if lo != hi] or [0]


def fitted(stages: list, model, rows: DataFrame, n: int) -> PipelineModel:
    """Pipeline of the stages and the model, fitted on ``n`` rows.

    Trees take hundreds of passes, one a level: they get the rows in even parts. Boosted trees get
    the features that vary only: they try every feature, and one that doesn't vary splits nothing.
    A forest draws the features it tries, so there all of them stay.
    """
    if isinstance(model, LogisticRegression):
        return Pipeline(stages=[*stages, model]).fit(rows)
    ready = Pipeline(stages=stages).fit(rows)
    done = ready.stages
    even = ready.transform(rows.repartition(even_parts(n, rows.sparkSession.sparkContext.defaultParallelism)))
    if isinstance(model, GBTClassifier):
        slicer = VectorSlicer(inputCol="features", outputCol="varying_features", indices=varying(ready.transform(rows)))
        done, even, model = [*done, slicer], slicer.transform(even), model.setFeaturesCol("varying_features")
    return PipelineModel([*done, model.fit(even.select(model.getFeaturesCol(), model.getLabelCol()))])


def fit_v1(train: DataFrame, name: str = "logistic", label: str = "clicked", **given) -> PipelineModel:
    n = check_trainable(train, label)
    numeric, categorical = existing(train, V1_NUMERIC), existing(train, V1_CATEGORICAL)
    return fitted(preprocess_v1(numeric, categorical), classifier(name, n, label, **given), train, n)


def fit_v2(train: DataFrame, name: str = "logistic", label: str = "clicked", **given) -> PipelineModel:
    n = check_trainable(train, label)
    numeric, categorical = existing(train, NUMERIC_FEATURES), existing(train, CATEGORICAL_FEATURES)
    ready = fill_constant(train, numeric, categorical)
    return fitted(preprocess_v2(numeric, categorical), classifier(name, n, label, **given), ready, n)


def fit_simulated(
    train: DataFrame, features: Sequence[str] = tuple(SIM_V3), standardize: bool = True, label: str = "clicked"
) -> PipelineModel:
    n = check_trainable(train, label)
    names = existing(train, features)
    ready = fill_constant(train, names, [])
    if standardize:
        stages = preprocess_v2(names, [])
    else:
        stages = [VectorAssembler(inputCols=names, outputCol="features")]
    return fitted(stages, classifier("logistic", n, label, max_iter=3000), ready, n)


def predict(model: PipelineModel, df: DataFrame, score_as: str = "model_score") -> DataFrame:
    """Append the probability of a click."""
    kept = df.columns
    return model.transform(df).select(*kept, vector_to_array("probability")[1].alias(score_as))


def save(model: PipelineModel, folder: str, name: str) -> None:
    model.write().overwrite().save(f"{folder}/{name}")


def load(folder: str, name: str) -> PipelineModel:
    if name not in ("logistic", "gbt", "forest"):
        raise ValueError(f"unsupported model name: {name}")
    return PipelineModel.load(f"{folder}/{name}")


def train_v1(df: DataFrame, split: str = "split", names: Sequence[str] = ("logistic", "gbt")) -> tuple[dict, DataFrame]:
    """Models by name and a report (model, n_rows, auc, accuracy, precision, recall) on the test rows."""
    train, test = df.where(F.col(split) == "train"), df.where(F.col(split) == "test")
    models, report = {}, None
    for name in names:
        models[name] = fit_v1(train, name)
        row = binary_metrics(predict(models[name], test), "model_score").withColumn("model", F.lit(name))
        report = row if report is None else report.unionByName(row)
    return models, report


def train_v2(df: DataFrame, split: str = "split", names: Sequence[str] = ("logistic", "gbt")) -> tuple[dict, DataFrame]:
    """Models by name and a report per model and part (val, test), with the sizes of all parts and the features."""
    train = df.where(F.col(split) == "train")
    numeric, categorical = existing(df, NUMERIC_FEATURES), existing(df, CATEGORICAL_FEATURES)
    models, report = {}, None
    for name in names:
        models[name] = fit_v2(train, name)
        for part in ("val", "test"):
            ready = fill_constant(df.where(F.col(split) == part), numeric, categorical)
            row = binary_metrics(predict(models[name], ready), "model_score").select(
                F.lit(name).alias("model"), F.lit(part).alias("part"), "n_rows", "auc", "accuracy"
            )
            report = row if report is None else report.unionByName(row)
    return models, report.crossJoin(part_sizes(df, split)).withColumns(
        {"numeric_features": F.lit(",".join(numeric)), "categorical_features": F.lit(",".join(categorical))}
    )


def part_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """One row: rows in all and of each part."""
    parts = [F.count_if(F.col(split) == part).alias(f"rows_{part}") for part in ("train", "val", "test")]
    return df.agg(F.count(F.lit(1)).alias("rows_total"), *parts)


def train_simulated(
    df: DataFrame, split: str = "split", features: Sequence[str] = tuple(SIM_V3), standardize: bool = True, k: int = 5
) -> tuple[PipelineModel, DataFrame]:
    """Model and report per part: sizes, ranking and feed-quality metrics of its own score."""
    names = existing(df, features)
    model = fit_simulated(df.where(F.col(split) == "train"), features, standardize)
    report = None
    for part in ("val", "test"):
        scored = predict(model, fill_constant(df.where(F.col(split) == part), names, []), "score")
        row = ranking_report(scored, "score", k).join(feed_quality_report(scored, "score", k), "sessions")
        row = row.withColumn("part", F.lit(part))
        report = row if report is None else report.unionByName(row)
    sizes = df.groupBy(F.col(split).alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
    return model, report.join(sizes, "part").withColumn("features", F.lit(",".join(names)))
