import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import previous_time
from millrace.operators import previous as module
from tests.helpers import rows


def sample(spark, n=600):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    keys = ["hot"] * 6 + ["b", "c", None]
    data = [
        (rng.choice(keys), start + dt.timedelta(seconds=rng.randrange(40_000), microseconds=rng.randrange(10**6)), i)
        for i in range(n)
    ]
    data += [("hot", start + dt.timedelta(days=40), n), ("lone", start, n + 1), ("hot", None, n + 2)]
    return spark.createDataFrame(data, "k string, t timestamp_ntz, id int")


@pytest.mark.parametrize("hot_rows, keys_bound, slices", [(10**6, 10_000, 4), (50, 10, 4), (1, 1000, 2), (0, 10_000, 50)])
def test_equals_a_plain_lag(spark, monkeypatch, hot_rows, keys_bound, slices):
    monkeypatch.setattr(module, "HOT_KEYS", keys_bound)
    monkeypatch.setattr(module, "SLICES", slices)
    df = sample(spark)
    plain = df.withColumn("p", F.lag("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(previous_time(df, "k", "t", "p", ties=["id"], hot_rows=hot_rows)) == rows(plain)


def test_hot_key_is_cut_into_many_groups(spark):
    """The sort of a hot key is spread: several partitions hold its rows."""
    df = sample(spark, 3000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = previous_time(df, "k", "t", "p", ties=["id"], hot_rows=50)
        tasks = out.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 4


def test_a_burst_is_cut_by_rows(spark, monkeypatch):
    """Most rows of the hot key lie in one hour of a year; no slice holds much more than its share."""
    monkeypatch.setattr(module, "SLICES", 20)
    start = dt.datetime(2024, 1, 1)
    data = [("hot", start + dt.timedelta(seconds=i), i) for i in range(3600)]
    data += [("hot", start + dt.timedelta(days=i), 10_000 + i) for i in range(1, 365)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id int")
    monkeypatch.setattr(module.F, "lag", lambda c: F.count("*"))  # rows of the slice so far
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        most = previous_time(df, "k", "t", "p", ties=["id"], hot_rows=50).agg(F.max("p")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert most < 1.5 * len(data) / 20
