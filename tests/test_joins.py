import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, left_join
from tests.helpers import rows


@pytest.fixture()
def low_limits(monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 40)
    monkeypatch.setattr(joins, "HOT_SHARE", 1 / 20)


def tables(spark):
    rng = random.Random(11)
    left = [(rng.choice(["hot", "copies", "cold1", "cold2", "none", None]), i) for i in range(60)]
    right = [("hot", i) for i in range(300)] + [("copies", 7)] * 200
    right += [(rng.choice(["cold1", "cold2", "cold3"]), i) for i in range(30)] + [(None, i) for i in range(100)]
    right_df = spark.createDataFrame(right, "k string, r int").repartition(6)
    return spark.createDataFrame(left, "k string, l int"), right_df


def test_hot_keys_are_found(spark, low_limits):
    _, right = tables(spark)
    found = {r.k: r._pieces for r in joins.hot_keys(right, "k").collect()}
    assert set(found) == {"hot", "copies"} and found["hot"] > found["copies"] > 1
    assert joins.hot_keys(right.filter("k like 'cold%'"), "k") is None
    assert joins.hot_keys(right.limit(0), "k") is None


def test_no_hot_key_below_the_row_limit(spark):
    _, right = tables(spark)
    assert joins.hot_keys(right, "k") is None


@pytest.mark.parametrize("broadcast", [True, False])
def test_salted_join_equals_the_plain_one(spark, low_limits, broadcast):
    left, right = tables(spark)
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = left_join(left, right, ["k"])
        salted = left_join(left, right, ["k"], split_hot=True)
        assert "_piece" in salted._jdf.queryExecution().toString()
        assert rows(salted) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_joined_in_several_tasks(spark, low_limits):
    left, right = tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = left_join(left, right, ["k"], split_hot=True)
        for key in ("hot", "copies"):
            tasks = salted.filter(F.col("k") == key).groupBy(F.spark_partition_id()).count().count()
            assert tasks > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_integer_keys_under_another_name(spark, low_limits):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, name string")
    right = spark.range(200).selectExpr("if(id < 150, 1, id) AS ref", "'x' AS name", "id AS n")
    salted = left_join(left, right, {"id": "ref"}, split_hot=True)
    assert salted.columns == ["id", "name", "n"]
    assert rows(salted) == rows(left_join(left, right, {"id": "ref"}))
