"""Structured Streaming jobs: ingest, anomaly confirmation, serving tables."""

from millrace.streaming.anomalies import anomaly_messages, start_anomalies, start_confirmation, to_files, to_kafka
from millrace.streaming.ingest import compact_ingested, scan_ingested, start_ingest
from millrace.streaming.serving import (
    compact_days,
    compact_rollup,
    read_keyed,
    read_rollup,
    refresh_rollup,
    start_upsert,
)
from millrace.streaming.sinks import start_files, start_kafka

__all__ = [
    "anomaly_messages",
    "compact_days",
    "compact_ingested",
    "compact_rollup",
    "read_keyed",
    "read_rollup",
    "refresh_rollup",
    "scan_ingested",
    "start_anomalies",
    "start_confirmation",
    "start_files",
    "start_ingest",
    "start_kafka",
    "start_upsert",
    "to_files",
    "to_kafka",
]
