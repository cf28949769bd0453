import json

from pyspark.sql import functions as F

from slatewright.sources import content as C
from slatewright.sources import online, tables
from slatewright.sources.snapshots import ENTITY, SnapshotStore

NOW = "2024-02-01 00:00:00"


def test_stories(spark, tmp_path):
    items = [
        {"id": 1, "type": "story", "title": "A", "url": "http://a", "by": "x", "time": 1704067200},
        {"id": 2, "type": "comment", "url": "http://b"},
        {"id": 3, "type": "story", "title": "no link"},
        {"id": 4, "type": "story", "url": "http://c"},
    ]
    (tmp_path / "run.json").write_text("\n".join(json.dumps(i) for i in items))
    got = {r["item_id"]: r for r in C.read_stories(spark, str(tmp_path), NOW).collect()}
    assert set(got) == {"hn_1", "hn_4"}
    assert str(got["hn_1"]["published_at"]).startswith("2024-01-01") and got["hn_4"]["title"] == ""


def test_feeds_keep_all_entries_unless_told_otherwise(spark, tmp_path):
    folder = tmp_path / "feed=bbc_world"
    folder.mkdir()
    entries = "".join(
        f"<item><title>t{i}</title><link>http://x/{i}</link><pubDate>Mon, 01 Jan 2024 0{i % 10}:00:00 GMT</pubDate></item>"
        for i in range(60)
    )
    (folder / "one.xml").write_text(f"<rss><channel><title>feed</title>{entries}</channel></rss>")
    got = C.read_feeds(spark, str(tmp_path), NOW).orderBy("place").collect()
    assert [r["title"] for r in got] == [f"t{i}" for i in range(60)]
    assert C.read_feeds(spark, str(tmp_path), NOW, first=50).count() == 50
    unlisted = spark.createDataFrame([("other", "tech")], "name string, category string")
    assert {r["category"] for r in C.read_feeds(spark, str(tmp_path), NOW, unlisted).collect()} == {"unknown"}
    assert got[3]["category"] == "world" and got[3]["published_at"].hour == 3 and got[3]["description"] == ""


def test_editorial(spark, tmp_path):
    payload = {"response": {"results": [
        {"id": "a/b", "webTitle": "web", "webUrl": "http://a", "webPublicationDate": "2024-01-01T00:00:00Z", "fields": {"headline": "head"}},
        {"id": "c", "webTitle": "web", "sectionName": "Tech", "fields": {}},
    ]}}
    (tmp_path / "p.json").write_text(json.dumps(payload, indent=1))
    got = {r["item_id"]: r for r in C.read_editorial(spark, str(tmp_path), NOW).collect()}
    assert got["guardian_a_b"]["title"] == "head" and got["guardian_a_b"]["category"] == "news"
    assert got["guardian_c"]["title"] == "web" and got["guardian_c"]["category"] == "Tech"


def test_normalize_dedupes_by_url_then_id(spark):
    rows = spark.createDataFrame(
        [(1, "a", "u1", "first"), (2, "b", "u1", "again"), (3, "a", "u2", "same id"), (4, "c", None, None), (5, "d", None, "no url either")],
        "n int, item_id string, url string, title string",
    )
    got = {r["item_id"]: r for r in C.normalize(rows, "n").collect()}
    assert set(got) == {"a", "c"} and got["a"]["title"] == "first" and got["c"]["content_length"] == 1
    assert len(C.normalize(rows, "n").columns) == 14


def test_create_append_query(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS feedtest LOCATION '{tmp_path}/db'")
    try:
        tables.create_tables(spark, "feedtest")
        tables.create_tables(spark, "feedtest")
        event = spark.createDataFrame([("u", "s", "click", "i")], "user_id string, session_id string, event_type string, item_id string")
        tables.append(tables.with_event_defaults(event), "events", "feedtest")
        tables.append(tables.with_event_defaults(event.withColumn("policy_name", F.lit("mine"))), "events", "feedtest")
        rows = tables.query(spark, "SELECT * FROM feedtest.events ORDER BY policy_name").collect()
        assert [r["policy_name"] for r in rows] == ["manual_feed", "mine"]
        assert rows[0]["model_version"] == "v0_manual" and len(rows[0]["event_id"]) == 36
    finally:
        spark.sql("DROP DATABASE feedtest CASCADE")


def test_snapshot_store_keeps_the_newest_and_expires(spark, tmp_path):
    def rows(values):
        return spark.createDataFrame(values, "impression_id string, user_id string, item_id string, timestamp string, user_prev_clicks int, preferred_category string")

    store = SnapshotStore(spark, str(tmp_path / "store"))
    first = rows([("1", "u", "i", "2024-01-02 00:00:00", 5, "x"), ("2", "v", "i", None, 1, None)])
    assert store.upsert(online.materialize(first, NOW, ["impression_id"])) == 0
    older = rows([("3", "u", "j", "2024-01-01 00:00:00", 9, "old")])
    assert store.upsert(online.materialize(older, NOW, ["impression_id"])) == 1
    assert store.status().where("version = 1").first()["user_count"] == 2
    keys = spark.createDataFrame([("u",), ("ghost",)], "entity_id string")
    schema = "user_prev_clicks int, user_prev_category string"
    live = {r["entity_id"]: r["features"] for r in online.lookup(keys, store.read(), "user", schema, NOW).collect()}
    assert live["u"]["user_prev_clicks"] == 5 and live["u"]["user_prev_category"] == "x" and live["ghost"] is None
    late = online.lookup(keys, store.read(), "user", schema, "2024-02-03 00:00:00").where("features is not null")
    assert late.count() == 0


def payload_rows(spark, values):
    """(entity_type, entity_id, payload, hour of the feature time or None)"""
    rows = [(t, i, p, None if h is None else f"2024-01-01 {h:02d}:00:00") for t, i, p, h in values]
    df = spark.createDataFrame(rows, "entity_type string, entity_id string, payload string, t string")
    return df.select(*ENTITY, "payload", F.col("t").cast("timestamp").alias("feature_timestamp"), F.lit(NOW).cast("timestamp").alias("expires_at"))


def files_of(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path), buckets=16)
    store.upsert(payload_rows(spark, [("user", f"u{k}", "first", 1) for k in range(100)]))
    before = files_of(tmp_path)
    assert store.upsert(payload_rows(spark, [("user", "u7", "second", 2)])) == 1
    added = {f for f in files_of(tmp_path) - before if not f.startswith("log/")}
    assert len(added) == 1 and before <= files_of(tmp_path)
    got = {r["entity_id"]: r["payload"] for r in store.read().collect()}
    assert len(got) == 100 and got["u7"] == "second" and got["u8"] == "first"
    wanted = spark.createDataFrame([("user", "u7"), ("user", "nobody")], "entity_type string, entity_id string")
    some = {r["entity_id"]: r["payload"] for r in store.read(wanted).collect()}
    assert some["u7"] == "second" and len(some) < 50


def test_store_equals_newest_wins_over_many_batches(spark, tmp_path):
    """Older, equal and missing times; compaction; retired versions are gone and the kept ones are whole."""
    import random

    draw, best = random.Random(3), {}
    store = SnapshotStore(spark, str(tmp_path), buckets=4, deltas=2, keep=2)
    assert store.read() is None and store.status() is None and store.version() is None
    for n in range(7):
        batch = {(draw.choice(["user", "item"]), f"e{draw.randint(0, 8)}"): (draw.choice([None, 1, 2, 3]), f"p{n}") for _ in range(5)} if n != 4 else {}
        assert store.upsert(payload_rows(spark, [(t, i, p, h) for (t, i), (h, p) in batch.items()]), f"batch {n}") == n
        for key, (h, p) in batch.items():
            if key not in best or (h or 0) >= (best[key][0] or 0):
                best[key] = (h, p)
        got = {(r["entity_type"], r["entity_id"]): r["payload"] for r in store.read().collect()}
        assert got == {k: p for k, (_, p) in best.items()}
        row = store.status().where(f"version = {n}").first()
        assert (row["user_count"], row["item_count"], row["source_dataset"]) == (sum(t == "user" for t, _ in best), sum(t == "item" for t, _ in best), f"batch {n}")
    assert {f.split("/")[1] for f in files_of(tmp_path) if f.startswith("log/")} == {"v=5", "v=6"}
    assert any(f.startswith("base=") for f in files_of(tmp_path))
    assert not any(f.startswith("delta=0/") for f in files_of(tmp_path))


def test_a_lost_job_leaves_the_last_version(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path), buckets=4)
    store.upsert(payload_rows(spark, [("user", "a", "one", 1), ("user", "b", "one", 1)]))
    # a delta without its manifest, as a job leaves it that is lost before the end
    lost = payload_rows(spark, [("user", "a", "lost", 9)]).withColumn("_version", F.lit(1)).withColumn("bucket", store._bucket())
    store._written(lost, "delta=1")
    assert {r["payload"] for r in store.read().collect()} == {"one"} and store.version() == 0
    assert store.upsert(payload_rows(spark, [("user", "b", "two", 2)])) == 1
    assert {r["entity_id"]: r["payload"] for r in store.read().collect()} == {"a": "one", "b": "two"}


def test_overlay_prefers_online_values(spark):
    frame = spark.createDataFrame([("u", "i", 1.0, "a", "b", 9.0)], "user_id string, item_id string, user_ctr_prior double, category string, user_prev_category string, item_age_hours double")
    users = spark.createDataFrame([("u", 0.5, "a")], "user_id string, user_ctr_prior double, user_prev_category string")
    items = spark.createDataFrame([("i", None, 1.0)], "item_id string, category string, item_age_hours double")
    row = online.overlay(frame, users, items).first()
    assert row["user_ctr_prior"] == 0.5 and row["category"] == "a" and row["preferred_category_match"] == 1
    assert row["recency_decay"] == 0.5
    assert online.overlay(frame, None, None).first() == frame.first()
