from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slatewright.plans import history
from slatewright.plans.features import item_features, labelled_impressions, user_features, with_preferred_7d

T0 = datetime(2024, 1, 1)


def test_backbone_cleans_and_defaults(spark):
    rows = [
        ("u", "i", "2024-01-06 10:00:00", "3", "-5"),
        ("u", "j", "not a time", "1", "1"),
        (None, "j", "2024-01-01 00:00:00", "1", "1"),
        ("u", "k", "2024-01-01 00:00:00", "bad", "bad"),
    ]
    raw = spark.createDataFrame(rows, "` USER_ID ` string, item_id string, timestamp string, clicked string, age_hours string")
    out = {r["item_id"]: r for r in history.impression_backbone(raw).collect()}
    assert set(out) == {"i", "k"}
    assert out["i"]["clicked"] == 1 and out["i"]["item_age_hours"] == 0.0 and out["i"]["is_weekend"] == 1
    assert out["k"]["clicked"] == 0 and out["k"]["impression_id"] == "1" and out["i"]["impression_id"] == "2"
    assert out["k"]["source"] == "unknown" and out["k"]["rank_position"] == -1
    with pytest.raises(ValueError, match="clicked"):
        history.impression_backbone(raw.drop("clicked"))


def test_point_in_time_never_looks_ahead_and_breaks_ties_by_row(spark):
    rows = [(str(i), f"u{i % 2}", f"i{i % 3}", T0 + timedelta(hours=i // 4), i % 2, "s", "c", 1.0) for i in range(40)]
    log = spark.createDataFrame(
        rows, "event_id string, user_id string, item_id string, timestamp timestamp, clicked int, source string, category string, age_hours double"
    )
    for hot_rows in (10**6, 5):
        out = history.training_rows(history.impression_backbone(log), hot_rows=hot_rows)
        check = history.temporal_validity(out).first()
        assert check["total_rows"] == 40 and check["future_user_features"] == 0 and check["future_item_features"] == 0
        strict = history.training_rows(history.impression_backbone(log), strict=True, hot_rows=hot_rows)
        assert strict.where("user_feature_time >= impression_time").count() == 0
        assert strict.where("impression_time = timestamp'2024-01-01'").where("user_prev_clicks > 0").count() == 0


def test_given_preferences_replace_the_previous_row(spark):
    log = spark.createDataFrame(
        [("1", "u", "i", T0, 0, "a", "x", "p"), ("2", "u", "i", T0 + timedelta(hours=1), 0, "b", "y", None)],
        "impression_id string, user_id string, item_id string, impression_time timestamp, clicked int, source string, category string, preferred_category string",
    )
    got = {r["impression_id"]: (r["user_prev_category"], r["user_prev_source"]) for r in history.user_history(log).collect()}
    assert got == {"1": ("p", "unknown"), "2": ("unknown", "a")}


def test_first_generation_features(spark):
    content = spark.createDataFrame(
        [("a", "s", "rss", "t", "dd", T0, "c"), ("b", None, "hackernews", None, None, None, None), ("c", "s", "rss", "", "", T0 + timedelta(hours=2), "c")],
        "item_id string, source string, source_type string, title string, description string, published_at timestamp, category string",
    )
    got = {r["item_id"]: r for r in item_features(content, "2024-01-01 10:00:00").collect()}
    assert got["a"]["age_hours"] == 10 and got["b"]["age_hours"] == 9 and got["b"]["hour_published"] == -1
    assert got["b"]["source"] == "unknown" and got["b"]["is_hackernews"] == 1 and got["a"]["description_length"] == 2
    events = spark.createDataFrame(
        [("1", T0, "u", "s", "impression", "a"), ("2", T0, "u", "s", "click", "a"), ("3", T0, "u", "s", "click", "a"), ("4", T0, "v", "s", "other", "b")],
        "event_id string, timestamp timestamp, user_id string, session_id string, event_type string, item_id string",
    )
    users = {r["user_id"]: r for r in user_features(events, content).collect()}
    assert users["u"]["recent_click_count"] == 2 and users["u"]["preferred_category"] == "c"
    assert users["v"]["recent_impression_count"] == 0 and users["v"]["preferred_source"] == "unknown"
    assert [r["clicked"] for r in labelled_impressions(events).collect()] == [1]
    later = events.where("event_id = '1'").withColumn("timestamp", F.lit(T0 + timedelta(days=7)))
    clicks = events.where("event_type = 'click'").join(content, "item_id")
    assert with_preferred_7d(later, clicks).first()["preferred_category_last_7d"] == "c"
    too_late = later.withColumn("timestamp", F.lit(T0 + timedelta(days=8)))
    assert with_preferred_7d(too_late, clicks).first()["preferred_category_last_7d"] == "unknown"
