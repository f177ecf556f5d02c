import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import epoch_seconds, number_text, round_scaled, whole_days_between


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (2.675, 2, 2.68), (0.125, 2, 0.13), (-0.125, 2, -0.13), (21.25, 1, 21.3), (None, 2, None)],
)
def test_round_scaled(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(round_scaled(F.col("v"), digits)).head()[0] == expected


@pytest.mark.parametrize("value", [4.51, 6.0, 33.3, 9999999.5, 1e7, 12345678.25, 123456789012.5, 1e16, 1.5e17])
def test_number_text_is_the_usual_form(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(number_text(F.col("v"))).head()[0] == repr(value)


def test_times_do_not_depend_on_the_session_zone(spark):
    before, after = dt.datetime(2024, 3, 10, 1, 59, 59), dt.datetime(2024, 3, 10, 2, 30, 0)
    df = spark.createDataFrame([(before, after)], "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a, b = df.select(epoch_seconds(F.col("a")), epoch_seconds(F.col("b"))).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert b - a == 1801
    assert a == int((before - dt.datetime(1970, 1, 1)).total_seconds())


def test_days_are_elapsed_not_midnights(spark, at):
    df = spark.createDataFrame([(at(23, day=1), at(1, day=3))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days_between(F.col("a"), F.col("b"))).head()[0] == 1
