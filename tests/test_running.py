"""Running operators against brute force, with and without hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slatewright.operators.running import RANGE_ROWS, asof_join, range_count, running, softmax, trailing

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        # one user owns half of the rows, and times repeat
        user = 1 if rng.random() < 0.5 else rng.randint(2, 9)
        rows.append((i, user, START + timedelta(minutes=rng.randint(0, 3000)), rng.randint(0, 1), rng.choice("abc") if rng.random() < 0.9 else None))
    frame = spark.createDataFrame(rows, "id int, user int, t timestamp, clicked int, category string").cache()
    return frame, rows


@pytest.mark.parametrize("hot_rows", [10**6, 30])
def test_running_matches_brute_force(log, hot_rows):
    frame, rows = log
    out = running(
        frame, ["user"], ["t", "id"], 
        sums={"clicks": F.col("clicked"), "n": F.lit(1)},
        previous={"before": F.col("category")},
        latest={"known": F.col("category")},
        hot_rows=hot_rows,
    )
    got = {r["id"]: (r["clicks"], r["n"], r["before"], r["known"]) for r in out.collect()}
    assert len(got) == len(rows)
    for user in {r[1] for r in rows}:
        clicks, n, before, known = 0, 0, None, None
        for row in sorted((r for r in rows if r[1] == user), key=lambda r: (r[2], r[0])):
            known = row[4] if row[4] is not None else known
            assert got[row[0]] == (clicks, n, before, known)
            clicks, n, before = clicks + row[3], n + 1, row[4]


@pytest.mark.parametrize("hot_rows", [10**6, 30])
def test_running_over_the_whole_frame(log, hot_rows):
    frame, rows = log
    out = running(frame, [], ["t", "id"], sums={"n": F.lit(1)}, inclusive=True, hot_rows=hot_rows)
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert {r["id"]: r["n"] for r in out.collect()} == want


@pytest.mark.parametrize("hot_rows", [10**6, 30])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_takes_the_last_earlier_row(spark, log, hot_rows, strict):
    frame, rows = log
    left = frame.where("id % 2 = 0").select("id", "user", F.col("t").alias("lt"))
    right = frame.where("id % 2 = 1").select("user", F.col("t").alias("rt"), F.col("id").alias("rid"), "category")
    out = asof_join(left, right, "user", "lt", "rt", ["rid", "category"], "found_at", ["rid"], strict, hot_rows)
    got = {r["id"]: (r["rid"], r["category"], r["found_at"]) for r in out.collect()}
    for row in (r for r in rows if r[0] % 2 == 0):
        earlier = [
            r for r in rows if r[0] % 2 == 1 and r[1] == row[1] and (r[2] < row[2] or (r[2] == row[2] and not strict))
        ]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        assert got[row[0]] == ((best[0], best[4], best[2]) if best else (None, None, None))


@pytest.mark.parametrize("hot_rows", [10**6, 30])
def test_trailing_window(log, hot_rows):
    frame, rows = log
    out = trailing(frame, ["user"], "t", 7200, {"c": F.col("clicked"), "n": F.lit(1)}, hot_rows)
    got = {r["id"]: (r["c"], r["n"]) for r in out.collect()}
    for row in rows:
        near = [r for r in rows if r[1] == row[1] and timedelta(seconds=1) <= row[2] - r[2] <= timedelta(seconds=7200)]
        assert got[row[0]] == (sum(r[3] for r in near), len(near))


def test_trailing_keeps_rows_without_a_time(log):
    frame, rows = log
    late = frame.withColumn("t", F.when(F.col("id") != rows[0][0], F.col("t")))
    got = {r["id"]: r["n"] for r in trailing(late, ["user"], "t", 7200, {"n": F.lit(1)}).collect()}
    assert len(got) == len(rows) and got[rows[0][0]] == 0


def test_softmax_is_the_same_for_hot_keys(log):
    frame, _ = log
    scored = frame.withColumn("s", F.col("id") / 10.0)
    plain = {r["id"]: r["p"] for r in softmax(scored, ["user"], {"p": "s"}, ["id"]).collect()}
    salted = {r["id"]: r["p"] for r in softmax(scored, ["user"], {"p": "s"}, ["id"], hot_rows=30).collect()}
    assert plain.keys() == salted.keys()
    assert all(abs(plain[i] - salted[i]) < 1e-12 for i in plain)
    by_user = {}
    for r in scored.select("id", "user").collect():
        by_user[r["user"]] = by_user.get(r["user"], 0.0) + salted[r["id"]]
    assert all(abs(total - 1.0) < 1e-9 for total in by_user.values())


def test_hot_keys_add_no_second_wide_shuffle(log):
    """Without hot keys the plan is one exchange and one window."""
    frame, _ = log
    plan = running(frame, ["user"], ["t", "id"], sums={"n": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def spread(df):
    """Rows of each range of the written table a running frame reads."""
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    return {r["_range"]: r["count"] for r in df.sparkSession.read.parquet(path).groupBy("_range").count().collect()}


def test_one_key_and_one_instant_run_in_many_tasks(spark):
    """All rows share key and time: the tie alone deals them, and the carry goes from range to range."""
    frame = spark.range(1000).select(F.lit(7).alias("user"), F.lit(START).alias("t"), F.col("id"), (F.col("id") % 3).alias("v"))
    out = running(
        frame, ["user"], ["t", "id"], sums={"before": F.col("v")}, previous={"last": F.when(F.col("v") > 0, F.col("v"))},
        latest={"one": F.when(F.col("v") == 1, F.col("id"))}, hot_rows=50,
    )
    sizes = spread(out)
    assert len(sizes) > 15 and max(sizes.values()) < 150
    total, last, one = 0, None, None
    for r in sorted(out.collect(), key=lambda r: r["id"]):
        one = r["id"] if r["v"] == 1 else one
        assert (r["before"], r["last"], r["one"]) == (total, last, one)
        total, last = total + r["v"], r["v"] or None


def test_ranges_of_few_rows_stay_few(spark):
    """A small ``hot_rows`` makes keys hot; it doesn't deal a large log into one range per few rows."""
    frame = spark.range(3000).select(F.lit("all").alias("item"), F.lit(START).alias("t"), F.col("id"))
    for keys in (["item"], []):
        out = running(frame, keys, ["t", "id"], sums={"n": F.lit(1)}, inclusive=True, hot_rows=5)
        sizes = spread(out)
        assert 32 < len(sizes) <= 64 and max(sizes.values()) < 300
        assert all(r["n"] == r["id"] + 1 for r in out.collect())
    assert range_count(216_000_000, 500) <= 4 * 216_000_000 // RANGE_ROWS
    assert range_count(216_000_000, RANGE_ROWS) == 217 and range_count(999, 500) == 2


@pytest.mark.parametrize("hot_rows", [10**6, 40])
def test_asof_of_many_rows_at_one_instant(spark, hot_rows):
    left = spark.range(500).select(F.lit("k").alias("k"), F.lit(START).alias("lt"), F.col("id"))
    right = spark.range(300).select(F.lit("k").alias("k"), F.lit(START).alias("rt"), F.col("id").alias("rid"))
    out = asof_join(left, right, "k", "lt", "rt", ["rid"], "at", ["rid"], hot_rows=hot_rows)
    assert {(r["id"], r["rid"]) for r in out.collect()} == {(i, 299) for i in range(500)}
    if hot_rows == 40:
        assert max(spread(out).values()) < 200
    none = asof_join(left, right, "k", "lt", "rt", ["rid"], "at", ["rid"], strict=True, hot_rows=hot_rows)
    assert {(r["id"], r["rid"]) for r in none.collect()} == {(i, None) for i in range(500)}


@pytest.mark.parametrize("hot_rows", [10**6, 20])
def test_null_keys_are_a_group_of_their_own(spark, hot_rows):
    rows = [(i, None if i % 2 else f"u{i % 3}", None if i % 5 else START) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, user string, t timestamp")
    got = {r["id"]: (r["n"], r["p"]) for r in running(frame, ["user"], ["t", "id"], sums={"n": F.lit(1)}, previous={"p": F.col("id")}, hot_rows=hot_rows).collect()}
    assert len(got) == 200
    for user in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2] is not None, r[2] or START, r[0]))
        for n, r in enumerate(own):
            assert got[r[0]] == (n, own[n - 1][0] if n else None)


def test_empty_frame(spark):
    frame = spark.createDataFrame([], "id int, user string")
    assert running(frame, ["user"], ["id"], sums={"n": F.lit(1)}, hot_rows=1).count() == 0
    assert running(frame, [], ["id"], sums={"n": F.lit(1)}, hot_rows=1).count() == 0
