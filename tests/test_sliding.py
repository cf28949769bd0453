"""Most frequent value in a trailing window against a loop over all events."""

import random
from datetime import datetime, timedelta

import pytest

from slatewright.operators.sliding import most_frequent_within

START = datetime(2024, 1, 1)


def plain(rows, events, seconds):
    out = []
    for i, user, t in rows:
        best = []
        for c in (2, 3):
            counts = {}
            for e in events:
                if t and e[1] and e[0] == user and e[c] is not None and timedelta(seconds=1) <= t - e[1] <= timedelta(seconds=seconds):
                    counts[e[c]] = counts.get(e[c], 0) + 1
            best.append(min(counts, key=lambda v: (-counts[v], v), default=None))
        out.append((i, *best))
    return sorted(out)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_against_brute_force(spark, ranges):
    draw = random.Random(ranges)
    when = lambda: None if draw.random() < 0.05 else START + timedelta(seconds=draw.randint(0, 4000))
    user = lambda: draw.choice(["hot"] * 6 + ["a", "b", None])
    events = [(user(), when(), draw.choice(["x", "y", "z", None]), draw.choice(["p", "q"])) for _ in range(300)]
    events += events[:20]
    rows = [(k, user(), when()) for k in range(200)] + [(500, "never", START), (501, "hot", START + timedelta(days=9))]
    found = most_frequent_within(
        spark.createDataFrame(rows, "id int, user string, timestamp timestamp"),
        spark.createDataFrame(events, "user string, timestamp timestamp, category string, source string"),
        ["user"], 600, {"category": "c7", "source": "s7"}, ranges=ranges,
    )
    assert found.columns == ["id", "user", "timestamp", "c7", "s7"]
    assert sorted((r.id, r.c7, r.s7) for r in found.collect()) == plain(rows, events, 600)


def test_nothing(spark):
    rows = spark.createDataFrame([], "id int, user string, timestamp timestamp")
    events = spark.createDataFrame([], "user string, timestamp timestamp, category string")
    assert most_frequent_within(rows, events, ["user"], 600, {"category": "c"}).count() == 0
    one = spark.createDataFrame([(1, "u", START)], "id int, user string, timestamp timestamp")
    assert [r.c for r in most_frequent_within(one, events, ["user"], 600, {"category": "c"}).collect()] == [None]
