"""Stage jobs: read the stage's inputs, build, write one Parquet table.

Each function is the body of one spark-submit job; ``python -m slatewright.plans.jobs
<stage> <root>`` runs a stage over a folder of stage tables.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatewright.operators import embeddings, retrieval
from slatewright.operators.position import split_by_time, split_stratified
from slatewright.plans import features, history, metrics, models, policy
from slatewright.session import configure
from slatewright.sources import online
from slatewright.sources.snapshots import SnapshotStore
from slatewright.sources.tables import load_stage, write_parquet, write_report


class Stages:
    """Stage tables below ``root``; every method builds and writes one of them."""

    def __init__(self, spark: SparkSession, root: str, as_of: str):
        self.spark, self.root, self.as_of = configure(spark), root, as_of

    def read(self, name: str, *times: str) -> DataFrame:
        return load_stage(self.spark, f"{self.root}/{name}", times)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{self.root}/{name}")
        return self.read(name)

    def item_features(self) -> DataFrame:
        return self.write(features.item_features(self.read("content_items"), self.as_of), "item_features")

    def user_features(self) -> DataFrame:
        return self.write(features.user_features(self.read("events"), self.read("content_items")), "user_features")

    def context_features(self) -> DataFrame:
        return self.write(features.context_features(self.read("events")), "context_features")

    def training_dataset(self) -> DataFrame:
        built = features.training_dataset(self.read("events"), self.read("content_items"), self.as_of)
        return self.write(built, "training_dataset")

    def impressions_v2(self) -> DataFrame:
        return self.write(history.impression_backbone(self.read("training_dataset")), "impressions_v2")

    def user_features_v2(self) -> DataFrame:
        return self.write(history.user_history(self.read("impressions_v2", "impression_time")), "user_features_v2")

    def item_features_v2(self) -> DataFrame:
        return self.write(history.item_history(self.read("impressions_v2", "impression_time")), "item_features_v2")

    def train_dataset_v2(self) -> DataFrame:
        joined = history.point_in_time(
            self.read("impressions_v2", "impression_time"), self.read("user_features_v2"), self.read("item_features_v2")
        )
        return self.write(joined, "train_dataset_v2")

    def item_embeddings_v2(self) -> DataFrame:
        return self.write(embeddings.item_embeddings(self.read("impressions_v2", "impression_time"), tie=("impression_id",)), "item_embeddings_v2")

    def _dims(self, items: DataFrame) -> int:
        return items.agg(F.max(F.size("item_vector"))).first()[0] or 1

    def user_embeddings_v2(self) -> DataFrame:
        items = self.read("item_embeddings_v2")
        built = embeddings.user_centroids(self.read("impressions_v2"), items, self._dims(items))
        return self.write(built, "user_embeddings_v2")

    def train_dataset_v2_embeddings(self) -> DataFrame:
        items = self.read("item_embeddings_v2")
        built = embeddings.similarity(
            self.read("train_dataset_v2"), items, self.read("user_embeddings_v2"), self._dims(items)
        )
        return self.write(built, "train_dataset_v2_embeddings")

    def candidates_v2(self) -> DataFrame:
        built = retrieval.retrieve(self.read("impressions_v2", "impression_time"), each_k=10, final_k=25)
        return self.write(built, "candidates_v2")

    def train_v1(self) -> DataFrame:
        split = split_stratified(self.read("training_dataset"), "clicked", ["event_id"])
        fitted, report = models.train_v1(split)
        for name, model in fitted.items():
            models.save(model, f"{self.root}/models", name)
        write_report(report, f"{self.root}/metrics")
        return report

    def train_v2(self) -> DataFrame:
        split = split_by_time(self.read("train_dataset_v2_embeddings", "impression_time"), "impression_time", ["impression_id"])
        fitted, report = models.train_v2(split)
        for name, model in fitted.items():
            models.save(model, f"{self.root}/models_v2", name)
        write_report(report, f"{self.root}/metrics_v2")
        return report

    def simulated_priors(self) -> DataFrame:
        return self.write(history.event_priors(self.read("simulated_events", "timestamp")), "training_dataset_simulated")

    def logged_policy(self) -> DataFrame:
        return self.write(policy.propensity_log(self.read("training_dataset_simulated", "timestamp")), "logged_policy")

    def counterfactual_metrics(self) -> DataFrame:
        report = metrics.counterfactual_report(self.read("logged_policy"))
        write_report(report, f"{self.root}/counterfactual_metrics")
        return report

    def online_features(self, source: str = "train_dataset_v2_embeddings") -> int:
        rows = online.materialize(self.read(source), self.as_of, ["impression_id"])
        return SnapshotStore(self.spark, f"{self.root}/online").upsert(rows, source)


# one generation after the other, each stage after its inputs
ORDER = [
    "item_features", "user_features", "context_features", "training_dataset", "impressions_v2", "user_features_v2",
    "item_features_v2", "train_dataset_v2", "item_embeddings_v2", "user_embeddings_v2", "train_dataset_v2_embeddings",
    "candidates_v2", "train_v1", "train_v2", "online_features",
]


def main(argv: list[str]) -> None:
    stage, root, as_of = argv
    spark = SparkSession.builder.appName(f"slatewright {stage}").getOrCreate()
    stages = Stages(spark, root, as_of)
    for name in ORDER if stage == "all" else [stage]:
        getattr(stages, name)()


if __name__ == "__main__":
    main(sys.argv[1:])
