"""Continuous ingest: topics to partitioned Parquet, unusable messages to rejects.

Every micro-batch adds files to the folders of its devices. ``compact_ingested``
writes closed dates once more in few files, and ``scan_ingested`` reads each date
from one of the two places.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.layout import spread
from millrace.plans.messages import route_messages
from millrace.schemas import EVENTS_TOPIC, TELEMETRY_TOPIC
from millrace.session import create_text, read_texts
from millrace.sources.files import scan_partitioned
from millrace.streaming.sinks import start_files

LAYOUT = ["date", "device_id"]


def start_ingest(
    read: Callable[[Sequence[str]], DataFrame],
    root: str,
    checkpoint: str,
    interval: str | None = None,
    ingest_date: Column | None = None,
    other_topics: Sequence[str] = (),
    rejects: bool = True,
) -> list[StreamingQuery]:
    """Start one file query each for telemetry, events and rejects below ``root``.

    ``read`` gives the message stream of some topics, such as ``message_stream``
    with its session and options filled in; the first two queries read only
    their own topic. Rows lie under ``date=<day of processing>/device_id=<device>``,
    in few files per device and micro-batch. Rejects, which may have no device,
    lie under their date; ``other_topics`` are read for these alone.
    """
    telemetry = route_messages(read([TELEMETRY_TOPIC]), ingest_date).telemetry
    events = route_messages(read([EVENTS_TOPIC]), ingest_date).events
    jobs = {"telemetry": (spread(telemetry, LAYOUT), LAYOUT), "events": (spread(events, LAYOUT), LAYOUT)}
    if rejects:
        everything = read([TELEMETRY_TOPIC, EVENTS_TOPIC, *other_topics])
        jobs["rejects"] = (route_messages(everything, ingest_date).rejects, ["date"])
    return [
        start_files(rows, f"{root}/{name}", f"{checkpoint}/{name}", "parquet", keys, interval)
        for name, (rows, keys) in jobs.items()
    ]


def _places(root: str, dataset: str) -> tuple[str, str, str]:
    """Where compacted datasets lie, one of them, and the notes of its finished dates."""
    compacted = f"{root.rstrip('/')}/compacted"
    return compacted, f"{compacted}/{dataset}", f"{compacted}/_finished/{dataset}"


def finished_dates(spark: SparkSession, root: str, dataset: str) -> dict[dt.date, int]:
    """The dates that are compacted, with their rows."""
    notes = read_texts(spark, _places(root, dataset)[2])
    return {dt.date.fromisoformat(name): int(rows) for name, rows in notes.items()}


def compact_ingested(
    spark: SparkSession,
    root: str,
    dataset: str,
    before: dt.date | str,
    schema: T.StructType | None = None,
    damaged: str = "skip",
) -> list[dt.date]:
    """Write the dates before ``before`` that are not compacted yet in few files per device; returns them.

    Ingest dates are days of processing, so a closed date gets no more rows. Folders
    get as many files as their size asks for (Spark's advisory partition size,
    also for a hot device), each sorted by device. The files of the stream stay as
    they are, since its log names them; they can expire by the sink's ``retention``.

    A date counts from its note on, which is written after its rows were counted in
    the new place. A run that breaks off before has left files without a note:
    nobody reads these, and the next run replaces them. With no closed dates nothing
    is written.
    """
    place, notes = _places(root, dataset)[1:]
    rows = scan_partitioned(spark, root, dataset, schema, damaged)
    closed = rows.filter(F.col("date") < F.lit(str(before)).cast("date"))
    done = finished_dates(spark, root, dataset)
    # No more than the calendar has; the dates come from folder names.
    dates = sorted({r.date for r in closed.select("date").distinct().collect()} - done.keys())
    if not dates:
        return []
    (
        rows.filter(F.col("date").isin(dates))
        .hint("rebalance", *LAYOUT)
        .sortWithinPartitions(*LAYOUT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT)
        .parquet(place)
    )
    counted = [
        {r.date: r["count"] for r in one.filter(F.col("date").isin(dates)).groupBy("date").count().collect()}
        for one in (rows, _compacted(spark, root, dataset, rows.schema))
    ]
    if counted[0] != counted[1]:
        raise ValueError(f"compacted dates of {root}/{dataset} have other rows than the stream wrote")
    for date, n in counted[1].items():
        create_text(spark, f"{notes}/{date}", str(n))
    return dates


def _compacted(spark: SparkSession, root: str, dataset: str, schema: T.StructType) -> DataFrame:
    return scan_partitioned(spark, _places(root, dataset)[0], dataset, schema, "trust")


def scan_ingested(
    spark: SparkSession,
    root: str,
    dataset: str,
    schema: T.StructType | None = None,
    damaged: str = "skip",
) -> DataFrame:
    """All rows of an ingested dataset: compacted dates from their few files, others as the stream wrote them.

    Both sides prune folders by filters on date and device. Columns are those of ``scan_partitioned``.
    """
    rows = scan_partitioned(spark, root, dataset, schema, damaged)
    dates = list(finished_dates(spark, root, dataset))
    if not dates:
        return rows
    done = F.col("date").isin(dates)
    fresh = rows.filter(~done | F.col("date").isNull())
    return fresh.unionByName(_compacted(spark, root, dataset, rows.schema).filter(done))
