"""Streaming sinks: partitioned files and a broker topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter


def trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run every ``interval``; without one, work off what is there and stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_files(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    interval: str | None = None,
) -> StreamingQuery:
    """Append to files; the sink's own log makes every row appear once after a failure."""
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return trigger(writer, interval).start(path)


def start_kafka(
    messages: DataFrame, topic: str, checkpoint: str, interval: str | None = None, **options: str
) -> StreamingQuery:
    """Send (key, value) rows to a topic; needs the Kafka package on the cluster."""
    writer = (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .options(**options)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return trigger(writer, interval).start()
