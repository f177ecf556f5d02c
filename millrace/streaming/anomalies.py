"""Anomaly confirmation over micro-batches, with a stored history per device."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.anomalies import NARROW, anomaly_rules, confirm_arrivals, describe, last_arrivals
from millrace.schemas import ANOMALIES, ANOMALIES_TOPIC
from millrace.session import path_exists, remove_path
from millrace.streaming.sinks import trigger

Deliver = Callable[[DataFrame, int], None]


def start_confirmation(
    rules: DataFrame,
    deliver: Deliver,
    checkpoint: str,
    interval: str | None = None,
    hot_rows: int = 1_000_000,
    snapshot_every: int = 20,
) -> StreamingQuery:
    """Confirm a stream of ``anomaly_rules`` rows in the order they arrive.

    Each micro-batch is confirmed by built-in windows over its rows and the
    stored history of its devices: their last 20 anomalies, kept below
    ``checkpoint`` as a change log. A micro-batch stores those of the devices it
    has rows of, and every ``snapshot_every`` micro-batches those of all devices;
    see ``history_before``. All is kept per micro-batch, so a repeated one finds
    what it found before. ``deliver`` gets the rows with ``is_confirmed`` and the
    id of the micro-batch, which may come twice after a failure. The order is
    that of micro-batches, then of message_id and entry, so where the input is
    cut makes no difference as long as message_ids ascend. A device with more
    than ``hot_rows`` rows in a micro-batch is worked on by several tasks.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, f"{checkpoint}/history"
        fresh = batch.select(*NARROW).withColumn("_fresh", F.lit(True)).persist()
        rows, others, base = fresh, None, batch_id
        if batch_id:
            base = last_snapshot(spark, log, batch_id)
            before = history_before(spark, log, base, batch_id, fresh.drop("_fresh").schema)
            devices = fresh.select(F.col("device_id").alias("_device")).distinct()
            same = F.col("device_id").eqNullSafe(F.col("_device"))
            own = before.join(devices, same, "left_semi").withColumn("_fresh", F.lit(False))
            rows, others = fresh.unionByName(own), before.join(devices, same, "left_anti")
        deliver(confirm_arrivals(rows, hot_rows=hot_rows).filter("_fresh").drop("_fresh"), batch_id)
        tails = last_arrivals(rows)
        if batch_id and batch_id - base < snapshot_every:
            place = f"{log}/{batch_id}{CHANGED}"
        else:
            place, tails = f"{log}/{batch_id}", tails if others is None else tails.unionByName(others)
        tails.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(place)
        fresh.unpersist()
        if batch_id and base == batch_id - 1:  # the snapshot is in use: what went before it is not needed any more
            forget_history(spark, log, base)

    writer = rules.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return trigger(writer, interval).start()


CHANGED = "-changed"


def last_snapshot(spark: SparkSession, log: str, batch_id: int) -> int:
    """The last micro-batch before ``batch_id`` that stored the history of all devices."""
    for earlier in range(batch_id - 1, -1, -1):
        if path_exists(spark, f"{log}/{earlier}/_SUCCESS"):
            return earlier
        if not path_exists(spark, f"{log}/{earlier}{CHANGED}/_SUCCESS"):
            break
    raise FileNotFoundError(f"no history before micro-batch {batch_id} in {log}")


def history_before(spark: SparkSession, log: str, base: int, batch_id: int, schema: T.StructType) -> DataFrame:
    """The last anomalies of each device before ``batch_id``: the snapshot ``base``, overruled by later changes.

    A device stands with all of its rows in every folder that has it, so the
    rows of its newest folder are its history.
    """
    folders = [f"{log}/{base}", *[f"{log}/{i}{CHANGED}" for i in range(base + 1, batch_id)]]
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(*folders)
    newest = F.max("batch_id").over(Window.partitionBy("device_id"))
    return stored.withColumn("_newest", newest).filter("batch_id <=> _newest").drop("batch_id", "_newest")


def forget_history(spark: SparkSession, log: str, base: int) -> None:
    """Remove what was stored before the snapshot ``base``."""
    for earlier in range(base - 1, -1, -1):
        folders = [f for f in (f"{log}/{earlier}", f"{log}/{earlier}{CHANGED}") if path_exists(spark, f)]
        if not folders:
            break
        for folder in folders:
            remove_path(spark, folder)


def to_files(path: str) -> Deliver:
    """Deliver each micro-batch into a folder of its own below ``path``, once.

    Read it with ``recursiveFileLookup``.
    """

    def deliver(rows: DataFrame, batch_id: int) -> None:
        folder = f"{path}/{batch_id:012d}"
        if not path_exists(rows.sparkSession, f"{folder}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(folder)

    return deliver


def to_kafka(topic: str, **options: str) -> Deliver:
    """Deliver (key, value) rows to a topic, at least once; needs the Kafka package on the cluster."""

    def deliver(rows: DataFrame, batch_id: int) -> None:
        rows.select("key", "value").write.format("kafka").options(**options).option("topic", topic).save()

    return deliver


def start_anomalies(
    telemetry: DataFrame,
    deliver: Deliver,
    checkpoint: str,
    message_id: str = "message_id",
    interval: str | None = None,
) -> StreamingQuery:
    """Rules, confirmation and wording for a stream of telemetry rows; delivers ``anomaly_messages``."""

    def worded(rows: DataFrame, batch_id: int) -> None:
        deliver(anomaly_messages(describe(rows)), batch_id)

    return start_confirmation(anomaly_rules(telemetry, message_id), worded, checkpoint, interval)


def anomaly_messages(anomalies: DataFrame) -> DataFrame:
    """Anomalies as (topic, key, value) messages: one JSON object each, keyed by device.

    Fields beyond the anomaly itself (its place in the message) travel along,
    so that readers can tell which of several rows for one key came last.
    """
    names = [f.name for f in ANOMALIES.fields]
    extra = [c for c in anomalies.columns if c not in names]
    return anomalies.select(
        F.lit(ANOMALIES_TOPIC).alias("topic"),
        F.col("device_id").alias("key"),
        F.to_json(F.struct(*names, *extra), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"),
    )
