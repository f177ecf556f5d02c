"""Small DataFrame helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ship_package, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns by name as ``column=type``, under their own names and nothing else.

    Extra columns of the input cannot clash with what an operator adds.
    """
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


T = TypeVar("T")
_KEPT: dict[str, object] = {}
_STAGE: list[int | None] = [None]


def enter_stage() -> None:
    """Drop what tasks of other stages have kept in this Python worker."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if stage != _STAGE[0]:
        _KEPT.clear()
        _STAGE[0] = stage


def kept_in_worker(key: str, make: Callable[[], T]) -> T:
    """What the tasks of one stage share in a Python worker; it goes when a task of another stage begins."""
    enter_stage()
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def release_memory() -> None:
    """Give memory that is free back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of each partition; it may give no batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_stage()
        try:
            for batch in batches:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
        finally:
            release_memory()

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


__all__ = ["enter_stage", "kept_in_worker", "map_batches", "pick", "release_memory", "ship_package", "table", "written"]
