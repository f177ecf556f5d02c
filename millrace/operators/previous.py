"""The previous time of the same key, also when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import epoch_seconds

# A key is hot when it holds more than 1/HOT_KEYS of all rows, so there can be
# at most HOT_KEYS of them however large the table is. That bounds the one
# broadcast below to HOT_KEYS * SLICES times.
HOT_KEYS = 2_000
SLICES = 500
# Cuts are looked up in blocks of so many, so that a row is compared with few.
BLOCK = 23


def previous_time(
    df: DataFrame,
    key: str,
    time: str,
    out: str,
    ties: Sequence[str] = (),
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``out``: ``time`` of the key's preceding row, null for its first.

    A plain ``lag`` sorts all rows of a key in one task. Here the times of a hot
    key (more than ``hot_rows`` rows and more than 1/HOT_KEYS of the table) are
    cut at quantiles into slices of about as many rows each, which are sorted
    apart; a burst is cut finer than a lull. Each slice gets one extra
    row carrying the last time before it, so ``lag`` needs nothing from another
    task. Other keys form one slice each. The rows are shuffled once.
    """
    seconds = epoch_seconds(F.col(time))
    rows = df.select(F.count(F.lit(1))).scalar()
    hot = (
        df.groupBy(F.col(key).alias("_key"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx(seconds, [i / SLICES for i in range(1, SLICES)], 20 * SLICES).alias("_cuts"),
        )
        .filter((F.col("_n") > hot_rows) & (F.col("_n") > rows / HOT_KEYS))
        .select("_key", F.array_distinct("_cuts").alias("_cuts"))
        .withColumn("_last", F.filter("_cuts", lambda _, i: i % BLOCK == BLOCK - 1))
    )
    # At most HOT_KEYS rows by the definition of hot.
    sliced = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_second", seconds)
    # Blocks that lie before the row whole, then what lies before it in the next one.
    sliced = sliced.withColumn("_whole", F.size(F.filter("_last", lambda cut: cut < F.col("_second"))) * BLOCK)
    rest = F.filter(F.slice("_cuts", F.col("_whole") + 1, F.lit(BLOCK)), lambda cut: cut < F.col("_second"))
    sliced = sliced.withColumn(
        "_slice", F.when(F.col("_cuts").isNotNull(), F.col("_whole") + F.size(rest)).otherwise(0)
    ).drop("_last", "_second", "_whole")
    # Last time of every slice of a hot key, handed to the key's next slice: at
    # most HOT_KEYS * SLICES rows in all.
    by_slice = Window.partitionBy(key).orderBy("_slice")
    edges = (
        sliced.filter(F.col("_cuts").isNotNull())
        .groupBy(key, "_slice")
        .agg(F.max(time).alias(time))
        .withColumn("_slice", F.lead("_slice").over(by_slice))
        .filter(F.col("_slice").isNotNull())
        .withColumn("_edge", F.lit(True))
    )
    within = Window.partitionBy(key, "_slice").orderBy(time, F.col("_edge").desc(), *ties)
    return (
        sliced.drop("_key", "_cuts")
        .withColumn("_edge", F.lit(False))
        .unionByName(edges, allowMissingColumns=True)
        .withColumn(out, F.lag(time).over(within))
        .filter(~F.col("_edge"))
        .select(*df.columns, out)
    )
