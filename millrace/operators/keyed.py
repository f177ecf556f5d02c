"""Keep the last row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one that arrived last.

    ``row_number() = 1`` lets Spark add a group limit before the shuffle, so a
    hot key sends at most one row per map task over the network.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in arrival]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
