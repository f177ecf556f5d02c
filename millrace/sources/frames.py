"""A DataFrame from a small dict of column lists held by the driver."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _type_of(values: Sequence) -> T.DataType:
    first = values[0] if values else None
    if isinstance(first, bool):
        return T.BooleanType()
    if isinstance(first, int):
        return T.IntegerType()
    if isinstance(first, float):
        return T.DoubleType()
    if isinstance(first, dt.datetime):
        return T.TimestampNTZType()
    if isinstance(first, dt.date):
        return T.DateType()
    if isinstance(first, decimal.Decimal):
        return T.DecimalType(9, 6)
    return T.StringType()


def frame_from_columns(
    spark: SparkSession, columns: Mapping[str, Sequence], schema: T.StructType | None = None
) -> DataFrame:
    """Rows from column lists, with a declared schema or one taken from the first values."""
    lengths = {len(values) for values in columns.values()}
    if len(lengths) > 1:
        raise ValueError(f"columns differ in length: {sorted(lengths)}")
    if schema is None:
        schema = T.StructType([T.StructField(c, _type_of(v)) for c, v in columns.items()])
    names = [f.name for f in schema.fields]
    return spark.createDataFrame(list(zip(*[columns[n] for n in names])), schema)
