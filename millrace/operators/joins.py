"""Left lookup join with one rule for clashing names and a way around hot keys."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than this share of the rows, so there are at
# most 1 / HOT_SHARE of them in a table of any size.
HOT_SHARE = 1 / 1000
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class HotLimits:
    """When a key is hot: so many rows, and this share of all rows (which bounds how many keys can be)."""

    rows: int
    share: float


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    split_hot: bool | HotLimits = False,
    look_in: DataFrame | None = None,
) -> DataFrame:
    """Left equi-join that keeps fan-out and lets the left side's names win.

    ``on`` lists shared key names or maps left key to right key. The right keys
    and every right column whose name the left side already has are dropped, so
    the result never holds an ambiguous name. The strategy is left to Spark:
    small sides are broadcast by their measured size, and skewed partitions of
    the left side are split at run time. The right side of a left join cannot
    be split that way; for right tables where one key may hold many rows set
    ``split_hot``, to True or to limits, which looks for such keys first (see ``hot_keys``). If the
    right side is itself a long plan, ``look_in`` can name a table it keeps all
    rows of, with the same key column.
    """
    keys = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    taken = set(left.columns)
    extra = [c for c in right.columns if c not in taken and c not in keys.values()]
    lookup = right.select(*[F.col(r).alias(l) for l, r in keys.items()], *extra)
    hot = None
    if split_hot and len(keys) == 1:
        ((name, right_name),) = keys.items()
        searched = right if look_in is None else look_in
        limits = split_hot if isinstance(split_hot, HotLimits) else HotLimits(HOT_ROWS, HOT_SHARE)
        hot = hot_keys(searched.select(F.col(right_name).alias(name)), name, limits.rows, limits.share)
    if hot is None:
        return left.join(lookup, list(keys), "left").select(*left.columns, *extra)
    return _salted(left, lookup, name, hot).select(*left.columns, *extra)


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None, share: float | None = None) -> DataFrame | None:
    """Keys with more than ``share`` of the rows and their number of pieces, or None.

    Runs at once, as one pass over the key column with a row count and a sketch
    of frequent values, which shuffles nothing but sketches. At most
    ``1 / share`` keys come back to the driver.
    """
    hot_rows, share = hot_rows or HOT_ROWS, share or HOT_SHARE
    most = min(math.ceil(1 / share), 10_000)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {8 * most})")
    found = (
        df.agg(F.greatest(F.count(F.lit(1)) * share, F.lit(float(hot_rows))).alias("limit"), sketch.alias("top"))
        .select("limit", F.inline("top"))
        .filter((F.col("count") > F.col("limit")) & F.col("item").isNotNull())
    )
    hot = [(r["item"], 2 * math.ceil(r["count"] / r["limit"])) for r in found.collect()]
    if not hot:
        return None
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("_pieces", T.IntegerType())])
    return df.sparkSession.createDataFrame(hot, schema)


def _salted(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join in which the right rows of each hot key are dealt to several tasks.

    The left rows of a hot key are repeated once per piece. A hot key has right
    rows by definition, so a repeated left row that finds none in its piece is
    dropped instead of being filled with nulls. The piece depends on the task
    that reads a row as well as on the row, so equal copies are dealt out too.
    """
    hot = F.broadcast(hot)  # at most 1 / HOT_SHARE rows
    pieces = F.coalesce("_pieces", F.lit(1))
    repeated = left.join(hot, key, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    dealt = (
        right.join(hot.withColumnRenamed("_pieces", "_of"), key, "left")
        .withColumn(
            "_piece",
            F.pmod(F.xxhash64(F.spark_partition_id(), *right.columns), F.coalesce("_of", F.lit(1))).cast("int"),
        )
        .withColumn("_found", F.lit(True))
        .drop("_of")
    )
    joined = repeated.join(dealt, [key, "_piece"], "left")
    return joined.filter(F.col("_pieces").isNull() | F.col("_found"))
