"""Serving tables: keyed anomalies, hourly rollup and unified device health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import round_scaled
from millrace.operators.keyed import latest_per_key

KEY = ["device_id", "timestamp"]
# The severity the views test for. The rules write upper-case names, so with
# this default no anomaly counts as severe; pass ("HIGH", "CRITICAL") for that.
HIGH_VALUES = ("high",)


def anomalies_latest(anomalies: DataFrame, arrival: Sequence[str] = ("message_id", "entry")) -> DataFrame:
    """The keyed anomaly table: per device and time the row that arrived last.

    Rows that carry ``time_slice`` (see ``confirm_batch``) are already
    partitioned by device and slice; as equal times share a slice, it can join
    the key, and no further shuffle is needed.
    """
    if "time_slice" in anomalies.columns:
        return latest_per_key(anomalies, [*KEY, "time_slice"], arrival).drop("time_slice")
    return latest_per_key(anomalies, KEY, arrival)


def anomaly_rollup(anomalies: DataFrame, high_values: Sequence[str] = HIGH_VALUES) -> DataFrame:
    """Anomalies per device and hour with the distinct types, sorted.

    Counts are made per type first, so that the list aggregate sees only
    distinct types.
    """
    by_type = anomalies.groupBy(
        "device_id", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour_bucket"), "anomaly_type"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~F.col("is_confirmed")).alias("_unconfirmed"),
        F.count_if(F.col("severity").isin(list(high_values))).alias("_high"),
    )
    return by_type.groupBy("device_id", "hour_bucket").agg(
        F.sum("_n").alias("total_anomalies"),
        F.sum("_unconfirmed").alias("unconfirmed_count"),
        F.sum("_high").alias("high_severity_count"),
        F.array_sort(F.collect_list("anomaly_type")).alias("anomaly_types"),
    )


def unified_device_health(
    device_health: DataFrame, anomalies: DataFrame, high_values: Sequence[str] = HIGH_VALUES
) -> DataFrame:
    """Daily device health with the pending anomalies of the day and a priority.

    Anomalies are counted per device and day before the join, which so stays as
    small as the health table. Repeated health rows are merged and multiply the
    counts, as they would in a join followed by grouping.
    """
    pending = ~F.col("is_confirmed")
    daily = anomalies.groupBy("device_id", F.to_date("timestamp").alias("date")).agg(
        F.count_if(pending).alias("_pending"),
        F.count_if(pending & F.col("severity").isin(list(high_values))).alias("_urgent"),
    )
    health = device_health.groupBy(
        "device_id",
        "date",
        "min_health_score",
        "days_since_maintenance",
        "vibration_anomalies",
        "temp_anomalies",
    ).agg(F.count(F.lit(1)).alias("_copies"))
    joined = health.join(daily, ["device_id", "date"], "left").withColumns(
        {
            "pending_anomalies": F.coalesce(F.col("_copies") * F.col("_pending"), F.lit(0)),
            "urgent_anomalies": F.coalesce(F.col("_copies") * F.col("_urgent"), F.lit(0)),
        }
    )
    decline = 1 - F.col("min_health_score")
    days = F.col("days_since_maintenance")
    load = F.least(F.col("pending_anomalies"), F.lit(10)).cast("double") / 10
    criticality = decline * 0.6 + load * 0.3 + F.when(days > 90, F.lit(0.1)).otherwise(F.lit(0.0))
    priority = (
        F.when((decline > 0.7) | (days > 120), "P0")
        .when((decline > 0.5) | (days > 90), "P1")
        .when((F.col("vibration_anomalies") > 5) | (F.col("temp_anomalies") > 3), "P2")
        .otherwise("P3")
    )
    return joined.select(
        "device_id",
        "date",
        F.col("min_health_score").alias("health_score"),
        "days_since_maintenance",
        "pending_anomalies",
        "urgent_anomalies",
        round_scaled(criticality, 2).alias("criticality_score"),
        priority.alias("priority"),
    )
