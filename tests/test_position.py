import random
from datetime import datetime, timedelta
from hashlib import md5
from statistics import median

from pyspark.sql import functions as F

from slatewright.operators.position import median_time_micros, median_within, split_by_time, split_stratified


def test_chronological_split_by_row_position(spark):
    rng = random.Random(3)
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=rng.randint(0, 40) * 3600, microseconds=rng.randint(0, 1))) for i in range(97)]
    got = {r["id"]: r["split"] for r in split_by_time(spark.createDataFrame(rows, "id int, t timestamp"), "t", ["id"]).collect()}
    ordered = sorted(rows, key=lambda r: (r[1], md5(str(r[0]).encode()).hexdigest()))
    a, b = int(97 * 0.7), int(97 * 0.85)
    for place, (i, _) in enumerate(ordered):
        assert got[i] == ("train" if place < a else "val" if place < b else "test")


def test_stratified_split_keeps_label_shares(spark):
    frame = spark.range(200).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    counts = {(r["y"], r["split"]): r["count"] for r in split_stratified(frame, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert counts == {(0, "train"): 112, (0, "test"): 48, (1, "train"): 28, (1, "test"): 12}


def test_medians(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 3), rng.choice([0.0, 1.5, rng.random() * 50])) for _ in range(60)]
    got = {r["g"]: r["median"] for r in median_within(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()}
    for g in got:
        assert abs(got[g] - median([v for k, v in rows if k == g])) < 1e-9
    times = [datetime(2024, 1, 1) + timedelta(microseconds=rng.randint(0, 10**12)) for _ in range(20)]
    found = median_time_micros(spark.createDataFrame([(t,) for t in times], "t timestamp"), "t")
    micros = [int((t - datetime(1970, 1, 1)).total_seconds()) * 10**6 + t.microsecond for t in times]
    assert found == median(micros)
    assert median_time_micros(spark.createDataFrame([(None,)], "t timestamp"), "t") is None
