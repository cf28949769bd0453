"""The stage jobs in order, each reading what the ones before it wrote."""

from pyspark.sql import functions as F

from slatewright.plans.jobs import Stages
from slatewright.sources import bench_tables as B
from slatewright.sources.tables import read_report, write_parquet

STAGES = [
    "item_features", "user_features", "context_features", "training_dataset", "impressions_v2", "user_features_v2",
    "item_features_v2", "train_dataset_v2", "item_embeddings_v2", "user_embeddings_v2", "train_dataset_v2_embeddings",
    "candidates_v2",
]


def test_stages_in_order(spark, folder, tmp_path):
    root = str(tmp_path)
    write_parquet(B.content(spark, folder), f"{root}/content_items")
    write_parquet(B.events(spark, folder).withColumn("rank_position", F.lit(1)), f"{root}/events")
    stages = Stages(spark, root, "2024-02-01 00:00:00")
    built = {name: getattr(stages, name)() for name in STAGES}
    shown = built["training_dataset"].count()
    assert shown == B.events(spark, folder, ["impression"]).count()
    assert built["train_dataset_v2_embeddings"].count() == built["impressions_v2"].count() == shown
    assert built["train_dataset_v2_embeddings"].where("abs(user_item_embedding_cosine) > 1.000001").count() == 0
    per_user = built["candidates_v2"].groupBy("user_id").count()
    assert per_user.where("count > 25").count() == 0
    assert per_user.count() == built["impressions_v2"].select("user_id").distinct().count()
    assert stages.online_features() == 0 and stages.online_features() == 1

    log = built["impressions_v2"].select("*", F.col("impression_time").alias("timestamp"), F.col("item_age_hours").alias("age_hours"))
    write_parquet(log, f"{root}/simulated_events")
    stages.simulated_priors()
    stages.logged_policy()
    stages.counterfactual_metrics()
    report = read_report(spark, f"{root}/counterfactual_metrics").first()
    assert report["n_rows"] == shown and report["ips_estimate"] >= 0
