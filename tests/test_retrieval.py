import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slatewright.operators.retrieval import by_attribute, item_base, item_stats, popular, preferences, recent, retrieve, retrieve_each, unseen

NAMES = ["news", "blog", "wire", "forum"]


@pytest.fixture(scope="module")
def shown(spark):
    rows = [
        (i, f"item_{i:02d}", f"user_{i % 3}", (i * 7) % 2, datetime(2025, 1, 1) + timedelta(hours=i), NAMES[i % 4], NAMES[::-1][i % 4])
        for i in range(20)
    ]
    return spark.createDataFrame(
        rows, "event_id int, item_id string, user_id string, clicked int, impression_time timestamp, source string, category string"
    ).cache()


def test_lists_have_at_most_k_items(shown):
    stats = item_stats(shown)
    top = popular(stats, 5).collect()
    assert len(top) <= 5 and {r["retrieval_strategy"] for r in top} == {"popular"}
    new = recent(stats, 5).orderBy("retrieval_score").collect()
    assert [r["retrieval_score"] for r in new] == [1, 2, 3, 4, 5]
    assert new[-1]["item_id"] == "item_19"
    assert by_attribute(item_base(shown), "category", 2).count() == 8


@pytest.mark.parametrize("head", [256, 8, 6])
def test_unseen_equals_the_naive_answer(shown, head):
    k = 5
    got = {}
    for r in unseen(shown, k, head).collect():
        got.setdefault(r["user_id"], []).append((r["retrieval_score"], r["item_id"]))
    rows = shown.collect()
    items = [r["item_id"] for r in sorted(rows, key=lambda r: r["impression_time"], reverse=True)]
    for user in {r["user_id"] for r in rows}:
        seen = {r["item_id"] for r in rows if r["user_id"] == user}
        want = [i for i in items if i not in seen][:k]
        assert [i for _, i in sorted(got[user], reverse=True)] == want


def test_unseen_tail_for_heavy_users(spark):
    """A user who saw all but the oldest items is answered beyond the head list."""
    at = datetime(2025, 1, 1)
    rows = [(i, f"i{i:03d}", "heavy" if i >= 3 else "light", 0, at + timedelta(minutes=i), "s", "c") for i in range(200)]
    log = spark.createDataFrame(
        rows, "event_id int, item_id string, user_id string, clicked int, impression_time timestamp, source string, category string"
    )
    got = {}
    for r in unseen(log, 5, head=16).collect():
        got.setdefault(r["user_id"], []).append((r["retrieval_score"], r["item_id"]))
    assert sorted(got["heavy"], reverse=True) == [(3, "i002"), (2, "i001"), (1, "i000")]
    assert [i for _, i in sorted(got["light"], reverse=True)] == [f"i{i:03d}" for i in (199, 198, 197, 196, 195)]


def test_unknown_user_has_no_preference_and_still_gets_items(spark, shown):
    assert preferences(shown).where("user_id = 'ghost'").count() == 0
    asked = spark.createDataFrame([("ghost",), ("user_0",)], "user_id string")
    got = retrieve(shown, asked, 5, 8).collect()
    assert {r["user_id"] for r in got} == {"ghost", "user_0"}
    ghost = [r for r in got if r["user_id"] == "ghost"]
    assert max(r["retrieval_strategy_count"] for r in ghost) <= 3
    assert len(ghost) <= 8


def test_lists_and_their_aggregates_hold_no_item_row(spark, shown):
    """The item's own columns join the blended candidates; no list, sort or aggregate of users holds them."""
    items = shown.select("item_id", F.concat(F.lit("row of "), F.col("item_id")).alias("row"))
    asks = spark.createDataFrame([("user_0", 3), ("user_1", 5), ("ghost", 4)], "user_id string, limit int")
    asked = retrieve_each(shown, asks, F.greatest(F.lit(10), 2 * F.col("limit")), F.lit(20), 100, item_columns=items)
    for found in (retrieve(shown, None, 10, 20, item_columns=items), asked):
        rows = found.collect()
        assert rows and all(r["item"]["row"] == f"row of {r['item_id']}" for r in rows)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Aggregate" in line and re.search(r"\bitem#", line)]
