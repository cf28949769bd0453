"""Streams against the batch answer on the whole log, which lands in several parts with late rows."""

from slatewright.plans import queries as Q
from slatewright.plans.features import event_pivot
from slatewright.sources import bench_tables as B


def test_arrivals_hold_every_row_with_late_ones(spark, folder):
    *parts, mark = [p.collect() for p in Q.arrivals(spark, folder)]
    assert sum(map(len, parts)) == B.events(spark, folder).count() and all(parts)
    assert [r.event_id for r in mark] == [None, None] and min(r.ts for r in mark) > max(r.ts for r in parts[-1])
    again = [p.count() for p in Q.arrivals(spark, folder, twice=True)]
    assert sum(again[:-1]) == 2 * sum(map(len, parts))


def test_duplicates_are_dropped(spark, folder):
    got = Q.QUERIES["stream_dedupe"](spark, folder)
    assert got.count() == got.select("event_id").distinct().count() == B.events(spark, folder).count()


def test_all_windows_equal_the_batch_counts(spark, folder):
    counts = Q.QUERIES["stream_counts"](spark, folder)
    want = {r["user_id"]: r["recent_click_count"] for r in event_pivot(B.events(spark, folder)).collect()}
    got = {r["user_id"]: r["n"] for r in counts.groupBy("user_id").agg({"recent_click_count": "sum"}).toDF("user_id", "n").collect()}
    assert got == want


def test_every_impression_is_labelled(spark, folder):
    got = Q.QUERIES["stream_labels"](spark, folder)
    assert got.count() == B.events(spark, folder).where("event_type = 'impression'").count()
