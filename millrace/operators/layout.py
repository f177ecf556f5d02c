"""Shuffle rows for a write into partition folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PIECES = 16
TASK_BYTES = 64 * 1024**2


def spread(rows: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Bring the rows of a folder together, in as many tasks as their size asks for.

    For a large table Spark measures the shuffled rows and makes tasks of its
    advisory partition size: a folder with k times the rows gets about k times
    the tasks and files. A table that the planner takes for small enough to give
    every shuffle partition less than ``TASK_BYTES`` uses all of them, since many
    small folders are better written side by side; so does a stream, which runs
    without adaptive execution. There, rows of a folder are dealt out by the
    task they come from, to at most ``MOST_PIECES`` tasks.
    """
    session = rows.sparkSession
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    adaptive = session.conf.get("spark.sql.adaptive.enabled") == "true" and not rows.isStreaming
    if adaptive and planned_bytes(rows) > tasks * TASK_BYTES:
        return rows.hint("rebalance", *folders)
    dealt = rows.withColumn("_part", F.spark_partition_id() % MOST_PIECES)
    return dealt.repartition(tasks, *folders, "_part").drop("_part")


def planned_bytes(rows: DataFrame) -> int:
    """The planner's estimate of the size; runs nothing."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
