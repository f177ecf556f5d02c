"""Topics: streaming sources of (topic, key, value) messages and their payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import ENVELOPE

MAX_BYTES_PER_BATCH = 8 * 1024**3
MAX_MESSAGES_PER_BATCH = 20_000_000


def message_stream(
    spark: SparkSession,
    topics: Sequence[str],
    fmt: str = "kafka",
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of (topic, key, value) rows of the given topics, text values.

    Broker messages also get a ``message_id`` made of partition and offset.
    With ``fmt="kafka"`` pass the broker options, such as
    ``**{"kafka.bootstrap.servers": ...}``, and ``startingOffsets="latest"`` to
    start at the end. Any file format takes ``path``, a folder of message
    files. A micro-batch is bounded by default, which also bounds what the
    stateful operators hold per key; override with the source's own options.
    """
    if fmt == "kafka":
        settings = {"maxOffsetsPerTrigger": str(MAX_MESSAGES_PER_BATCH), **options}
        raw = spark.readStream.format("kafka").options(**settings).option("subscribe", ",".join(topics)).load()
        return raw.select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            (F.shiftleft(F.col("partition").cast("bigint"), 48) + F.col("offset")).alias("message_id"),
        )
    bounded = {"maxBytesPerTrigger", "maxFilesPerTrigger"} & set(options)
    settings = options if bounded else {"maxBytesPerTrigger": str(MAX_BYTES_PER_BATCH), **options}
    raw = spark.readStream.format(fmt).schema(ENVELOPE).options(**settings).load(path)
    return raw.filter(F.col("topic").isin(list(topics)))


def parse_payload(messages: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of the JSON payloads, an object or an array; unreadable ones give none.

    ``keep`` names columns of the message to repeat on its records.
    """
    records = F.from_json("value", T.ArrayType(schema))
    return messages.select(*keep, F.inline(records))
