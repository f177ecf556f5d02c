"""Silver and gold tables from what earlier runs stored, so that a run reads its own days only.

Three kinds of results are kept below a ``state`` folder, each in a folder a run,
which a repeated run replaces:

- ``moments``: count, mean and sum of squared deviations of the outlier columns,
  merged by Chan's formula into the limits over all runs;
- ``parts``: counts, sums and extremes per device and day, merged into the failure
  prediction;
- ``last_events``: the time of each device's last event, which the first event of
  the next run counts its days from.

A run is named by a day; runs must be stored in the order of their days for
``last_events``, in any order for the others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import round_scaled
from millrace.plans.iot import OUTLIER_COLUMNS, OUTLIER_DEVIATIONS, prediction_day, rated, silver_events, silver_telemetry
from millrace.schemas import struct_of
from millrace.session import path_exists

RUN = T.StructField("run_day", T.DateType())
MOMENTS = struct_of(column=T.StringType(), n=T.DoubleType(), mean=T.DoubleType(), m2=T.DoubleType())
PARTS = struct_of(
    device_id=T.StringType(),
    date=T.DateType(),
    readings=T.LongType(),
    vibration_anomalies=T.LongType(),
    temperatures=T.LongType(),
    temperature_sum=T.DoubleType(),
    peak_temp=T.DoubleType(),
    peak_energy=T.DoubleType(),
    worst_health_score=T.DoubleType(),
)
LAST_EVENTS = struct_of(device_id=T.StringType(), event_timestamp=T.TimestampNTZType())


def _store(rows: DataFrame, state: str, kind: str, run_day: dt.date | str) -> None:
    rows.write.mode("overwrite").parquet(f"{state}/{kind}/{RUN.name}={run_day}")


def _stored(spark: SparkSession, state: str, kind: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, RUN])).parquet(f"{state}/{kind}")


def store_telemetry(telemetry: DataFrame, state: str, run_day: dt.date | str) -> None:
    """Keep the moments and the parts of the telemetry of one run."""
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).cast("double").alias("n"),
            F.avg(c).alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("m2"),
        )
        for c in OUTLIER_COLUMNS
    ]
    _store(telemetry.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs")), state, "moments", run_day)
    _store(telemetry_parts(silver_telemetry(telemetry)), state, "parts", run_day)


def telemetry_parts(silver: DataFrame) -> DataFrame:
    """One row per device and day that merges with others by sums, maxima and minima."""
    return silver.groupBy("device_id", "date").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if("is_vibration_anomaly").alias("vibration_anomalies"),
        F.count("temperature").alias("temperatures"),
        F.sum("temperature").alias("temperature_sum"),
        F.max("temperature").alias("peak_temp"),
        F.max("energy_usage").alias("peak_energy"),
        F.min("composite_health_score").alias("worst_health_score"),
    )


def merged_limits(moments: DataFrame) -> Column:
    """Mean + 2 standard deviations of each outlier column over all stored runs, as a scalar struct.

    The table has two rows a run; they are merged one after another. A column
    with fewer than two readings has no limit.
    """
    number = lambda x: F.lit(x).cast("double")
    empty = F.struct(number(0).alias("n"), number(0).alias("mean"), number(0).alias("m2"))

    def merge(total: Column, part: Column) -> Column:
        n, delta = total["n"] + part["n"], part["mean"] - total["mean"]
        return F.struct(
            n.alias("n"),
            (total["mean"] + delta * part["n"] / n).alias("mean"),
            (total["m2"] + part["m2"] + delta * delta * total["n"] * part["n"] / n).alias("m2"),
        )

    def limit(name: str) -> Column:
        parts = F.collect_list(F.when((F.col("column") == name) & (F.col("n") > 0), F.struct("n", "mean", "m2")))
        total = F.aggregate(F.sort_array(parts), empty, merge)
        deviation = F.sqrt(F.try_divide(total["m2"], total["n"] - 1))
        return F.when(total["n"] > 1, total["mean"] + OUTLIER_DEVIATIONS * deviation).alias(name)

    return moments.agg(F.struct(*[limit(c) for c in OUTLIER_COLUMNS])).scalar()


def silver_telemetry_of(telemetry: DataFrame, state: str) -> DataFrame:
    """Silver rows of some telemetry, with outliers by the limits over all stored runs."""
    moments = _stored(telemetry.sparkSession, state, "moments", MOMENTS)
    return silver_telemetry(telemetry, merged_limits(moments))


def failure_prediction_of(
    spark: SparkSession, state: str, as_of: dt.date | str | None = None, lookback_days: int = 60
) -> DataFrame:
    """``iot.failure_prediction`` over all stored runs, from their parts alone."""
    day = prediction_day(as_of, lookback_days)
    today = F.col("date") == day
    parts = _stored(spark, state, "parts", PARTS).filter(F.col("date") >= F.date_sub(day, lookback_days))
    stats = parts.groupBy("device_id").agg(
        F.sum("vibration_anomalies").alias("anomalies_7d"),
        round_scaled(F.try_divide(F.sum("temperature_sum"), F.sum("temperatures")), 1).alias("avg_temp_7d"),
        F.max("peak_energy").alias("peak_energy_7d"),
        F.min("worst_health_score").alias("worst_health_score_7d"),
        F.sum(F.when(today, F.col("vibration_anomalies"))).alias("anomalies_24h"),
        F.max(F.when(today, F.col("peak_temp"))).alias("peak_temp_24h"),
    )
    return rated(stats, day)


def silver_events_of(
    events: DataFrame, state: str, run_day: dt.date | str, hot_rows: int = 1_000_000
) -> DataFrame:
    """Silver rows of the events of one run; what came before is known by one row per device.

    Events must not be older than those of earlier runs: one that is gets 0
    days, and the rows of earlier runs stay as they are.
    """
    spark, kept = events.sparkSession, events.select(*LAST_EVENTS.fieldNames())
    carried = None
    if path_exists(spark, f"{state}/last_events"):
        stored = _stored(spark, state, "last_events", LAST_EVENTS)
        earlier = stored.filter(F.col(RUN.name) < F.lit(str(run_day)).cast("date"))
        newest = earlier.agg(F.max(RUN.name)).scalar()
        carried = stored.filter(F.col(RUN.name) == newest).select(*LAST_EVENTS.fieldNames())
        kept = kept.unionByName(carried)
    last = kept.groupBy("device_id").agg(F.max("event_timestamp").alias("event_timestamp"))
    _store(last.filter(F.col("event_timestamp").isNotNull()), state, "last_events", run_day)
    return silver_events(events, hot_rows, carried)
