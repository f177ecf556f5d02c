"""The keyed anomaly table and the hourly rollup, fed by streams.

Both only ever grow while the stream runs. The keyed table is kept as versions:
every micro-batch appends its rows with its ``batch_id``, and readers take the
latest row per key. The rollup is kept as changes: every micro-batch appends, for
each device and hour, what it adds, less what the rows took that it replaces, and
readers sum. A micro-batch repeated after a failure appends equal rows, which
readers count once. ``compact_days`` and ``compact_rollup`` fold closed days
together.

The keyed table lies in buckets by device and hour, so that its readers need no
shuffle to find the latest row of each key.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import epoch_seconds
from millrace.operators.keyed import latest_per_key
from millrace.operators.layout import spread
from millrace.plans.serving import HIGH_VALUES, KEY, anomaly_rollup
from millrace.schemas import struct_of
from millrace.session import create_text, full_path, path_exists, read_texts, remove_path, scratch_dir
from millrace.streaming.sinks import trigger

ROLLUP_KEY = ["device_id", "hour_bucket"]
ARRIVAL = ("message_id", "entry")
# Hours since 1970, kept beside the rows of the keyed table: a plain number, which Parquet can skip by.
HOUR = T.StructField("hour_number", T.LongType())
# Rows of a key share both, and a hot device is spread over as many buckets as it has hours.
BUCKET_KEY = ["device_id", HOUR.name]
COUNTS = ["n", "unconfirmed", "high"]
# What one micro-batch changes in an hour of a device. A folded row stands for all micro-batches up to its own.
CHANGES = struct_of(
    device_id=T.StringType(),
    hour_bucket=T.TimestampNTZType(),
    folded=T.BooleanType(),
    parts=T.ArrayType(struct_of(anomaly_type=T.StringType(), **{n: T.LongType() for n in COUNTS})),
)


def _write_version(rows: DataFrame, batch_id: int, path: str, sort: Sequence[str]) -> None:
    _append(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, sort)


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """How many buckets a keyed table has, by the note beside its rows; None if it was begun without."""
    note = read_texts(spark, f"{path}/_layout").get("buckets")
    return int(note) if note else None


def _bucketed_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> str:
    """The catalog's name for the folder; only tables of the catalog are read by buckets.

    The name follows from path, columns and buckets, and the rows stay where they
    are, so that any session can make the entry anew.
    """
    place, columns = full_path(spark, path), _version_schema(T.StructType([*schema.fields, HOUR]))
    key = f"{place} {buckets} {columns.simpleString()}"
    name = f"millrace_keyed_{hashlib.sha256(key.encode()).hexdigest()[:24]}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    location = place.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY (day) "
        f"CLUSTERED BY ({', '.join(BUCKET_KEY)}) SORTED BY (timestamp) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)  # days that other sessions have added
    return name


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for one step; writes into catalog tables do not take it as an option."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _append(rows: DataFrame, path: str, sort: Sequence[str], mode: str = "append") -> None:
    spark = rows.sparkSession
    buckets = bucket_count(spark, path)
    if buckets:
        table = _bucketed_table(spark, path, rows.schema, buckets)
        dealt = rows.withColumn(HOUR.name, hour_number()).repartition(buckets, *BUCKET_KEY)
        dealt = dealt.select(*spark.table(table).columns)
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            dealt.write.insertInto(table, overwrite=mode == "overwrite")
        return
    (
        spread(rows, ["day"])
        .sortWithinPartitions("day", *sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def _version_schema(schema: T.StructType) -> T.StructType:
    fields = {f.name: f for f in schema.fields if f.name not in ("day", "batch_id")}
    keys = [T.StructField("batch_id", T.LongType()), T.StructField("day", T.DateType())]
    return T.StructType([*fields.values(), *keys])


def _read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_version_schema(schema)).parquet(path)


def start_upsert(
    anomalies: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    rollup_path: str | None = None,
    high_values: Sequence[str] = HIGH_VALUES,
    buckets: int | None = None,
) -> StreamingQuery:
    """Load anomalies into the keyed table at ``path``, by day, in buckets sorted by time.

    A new table gets ``buckets`` buckets for each day (else as many as the session
    has shuffle partitions), which it keeps; a micro-batch adds a file to each
    bucket it touches. A table begun without buckets goes on without.

    With ``rollup_path`` the hourly rollup follows, at a cost that goes with the
    new rows: a micro-batch counts its own keys and takes off what the rows
    counted that these keys had before, however old they are. So late rows count,
    and equal keys count once. Rows without a readable time have a null day, and
    each device a null hour for them.

    The changes are appended before the rows. Where the rows of a micro-batch are
    found, its changes are complete and are not worked out again, so a repeat is
    right also after its days were folded.
    """
    schema, runs, session = anomalies.schema, [], anomalies.sparkSession
    if not path_exists(session, path):
        number = buckets or int(session.conf.get("spark.sql.shuffle.partitions"))
        create_text(session, f"{path}/_layout/buckets", str(number))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("day", F.to_date("timestamp")).withColumn(HOUR.name, hour_number()).persist()
        if rollup_path:
            fresh, removed, done = latest_per_key(rows, KEY, ARRIVAL), None, False
            if runs or _has_rows(spark, path):
                hours = [r[0] for r in rows.select(HOUR.name).distinct().collect()]  # no more than the calendar has
                known = stored_hours(spark, path, schema, hours)
                # Only the first micro-batch of a run can be a repeat.
                done = not runs and not known.filter(F.col("batch_id") == batch_id).isEmpty()
                removed = replaced_rows(known.filter(F.col("batch_id") < batch_id), fresh)
            if not done:
                changes = rollup_changes(fresh, removed, high_values)
                _write_version(changes.withColumn("day", F.to_date("hour_bucket")), batch_id, rollup_path, ROLLUP_KEY)
        _write_version(rows, batch_id, path, ["timestamp", "severity"])
        rows.unpersist()
        runs[:] = [batch_id]

    writer = anomalies.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return trigger(writer, interval).start()


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a first micro-batch has been written; before it there is at most the note on buckets."""
    return path_exists(spark, path) and not spark.read.schema("batch_id long").parquet(path).isEmpty()


def hour_number():
    return F.floor(epoch_seconds(F.col("timestamp")) / 3600).cast("bigint")


def stored_hours(spark: SparkSession, path: str, schema: T.StructType, hours: Sequence[int | None]) -> DataFrame:
    """The versions in the keyed table whose time is in one of ``hours`` (numbers; None: no time).

    Folders of other days are not listed, and in the others Parquet skips what
    holds other hours, as the files are sorted by time.
    """
    numbers = sorted(h for h in hours if h is not None)
    days = sorted({dt.date(1970, 1, 1) + dt.timedelta(hours=h) for h in numbers})
    day, hour = F.col("day").isin(days), F.col(HOUR.name).isin(numbers)
    if len(numbers) < len(hours):
        day, hour = day | F.col("day").isNull(), hour | F.col(HOUR.name).isNull()
    return _read_versions(spark, path, T.StructType([*schema.fields, HOUR])).filter(day & hour)


def replaced_rows(versions: DataFrame, fresh: DataFrame) -> DataFrame:
    """The rows that the keys of ``fresh`` had in the versions before.

    Other keys go before the versions are merged, so that only versions of
    these keys are shuffled and sorted.
    """
    keys = fresh.select(*[F.col(c).alias(f"fresh_{c}") for c in KEY])
    same = [F.col(c).eqNullSafe(F.col(f"fresh_{c}")) for c in KEY]
    return latest_per_key(versions.join(keys, same, "left_semi"), KEY, ["batch_id", *ARRIVAL])


def rollup_changes(
    added: DataFrame, removed: DataFrame | None = None, high_values: Sequence[str] = HIGH_VALUES
) -> DataFrame:
    """Per device and hour, the signed counts of each type that has changed."""
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour_bucket")

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        unconfirmed = (~F.col("is_confirmed")).cast("bigint")
        high = F.col("severity").isin(list(high_values)).cast("bigint")
        counts = [F.lit(1).cast("bigint"), F.coalesce(unconfirmed, F.lit(0)), F.coalesce(high, F.lit(0))]
        return rows.select("device_id", hour, "anomaly_type", *[(sign * c).alias(n) for c, n in zip(counts, COUNTS)])

    counts = signed(added, 1) if removed is None else signed(added, 1).unionByName(signed(removed, -1))
    by_type = counts.groupBy(*ROLLUP_KEY, "anomaly_type").agg(*[F.sum(n).alias(n) for n in COUNTS])
    changed = by_type.filter(" OR ".join(f"{n} <> 0" for n in COUNTS))
    return changed.groupBy(*ROLLUP_KEY).agg(
        F.lit(False).alias("folded"), F.sort_array(F.collect_list(F.struct("anomaly_type", *COUNTS))).alias("parts")
    )


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType, arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The keyed table: per device and time the last row of the last micro-batch.

    ``schema`` is that of the stream; equal keys share a day, so a filter on
    ``day`` prunes folders. They share a bucket too, so each bucket is read by one
    task, and nothing is shuffled. For that, the session's catalog gets an entry
    for the folder.
    """
    buckets = bucket_count(spark, path)
    if buckets is None:
        versions = _read_versions(spark, path, schema)
        return latest_per_key(versions, ["day", *KEY], ["batch_id", *arrival]).drop("batch_id")
    table = _bucketed_table(spark, path, schema, buckets)
    spark.catalog.refreshTable(table)
    newest = latest_per_key(spark.table(table), ["day", HOUR.name, *KEY], ["batch_id", *arrival])
    return newest.drop("batch_id", HOUR.name)


def _folded(changes: DataFrame) -> DataFrame:
    """The changes of each hour in one row, with the last of their micro-batches.

    Repeated micro-batches count once, and those that a folded row stands for do
    not count beside it. All steps work on one shuffle by device and hour.
    """
    together = changes.repartition(*ROLLUP_KEY).dropDuplicates([*ROLLUP_KEY, "batch_id", "folded"])
    hour = Window.partitionBy(*ROLLUP_KEY)
    marked = together.withColumns(
        {
            "_mark": F.max(F.when(F.col("folded"), F.col("batch_id"))).over(hour),
            "last_batch": F.max("batch_id").over(hour),
        }
    )
    live = marked.filter(F.col("folded") | F.col("_mark").isNull() | (F.col("batch_id") > F.col("_mark")))
    lasts = live.select(*ROLLUP_KEY, "last_batch", F.inline_outer("parts"))
    by_type = lasts.groupBy(*ROLLUP_KEY, "anomaly_type").agg(
        F.max("last_batch").alias("last_batch"), *[F.sum(n).alias(n) for n in COUNTS]
    )
    return by_type.groupBy(*ROLLUP_KEY).agg(
        F.max("last_batch").alias("batch_id"),
        F.sort_array(F.collect_list(F.when(F.col("n") != 0, F.struct("anomaly_type", *COUNTS)))).alias("parts"),
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The hourly rollup: the sums of all changes, with the types that are left."""
    hours = _folded(_read_versions(spark, path, CHANGES))

    def total(name: str):
        return F.aggregate("parts", F.lit(0).cast("bigint"), lambda sofar, part: sofar + part[name])

    return hours.filter(F.size("parts") > 0).select(
        *ROLLUP_KEY,
        total("n").alias("total_anomalies"),
        total("unconfirmed").alias("unconfirmed_count"),
        total("high").alias("high_severity_count"),
        F.filter(F.transform("parts", lambda part: part["anomaly_type"]), lambda t: t.isNotNull()).alias("anomaly_types"),
    )


def _replace_days(rows: DataFrame, path: str, sort: Sequence[str]) -> None:
    """Write the rows to a scratch folder first, so that no file is read and overwritten in one job."""
    folder = scratch_dir(rows.sparkSession, "compact")
    rows.write.parquet(folder)
    _append(rows.sparkSession.read.schema(rows.schema).parquet(folder), path, sort, "overwrite")
    remove_path(rows.sparkSession, folder)


def compact_days(
    spark: SparkSession, path: str, schema: T.StructType, before: dt.date | str, arrival: Sequence[str] = ARRIVAL
) -> None:
    """Fold the versions of each day before ``before`` that has several into one.

    Run it while no stream writes to these days. Days with one version are left
    alone.
    """
    closed = F.col("day") < F.lit(str(before)).cast("date")
    versions = _read_versions(spark, path, T.StructType([*schema.fields, HOUR])).filter(closed)
    several = versions.groupBy("day").agg(F.count_distinct("batch_id").alias("n")).filter("n > 1")
    days = [r.day for r in several.collect()]
    if days:
        newest = latest_per_key(versions.filter(F.col("day").isin(days)), ["day", *KEY], ["batch_id", *arrival])
        _replace_days(newest, path, ["timestamp", "severity"])


def compact_rollup(spark: SparkSession, path: str, before: dt.date | str) -> None:
    """Sum the changes of each day before ``before`` that has any not summed yet, under the same conditions."""
    changes = _read_versions(spark, path, CHANGES).filter(F.col("day") < F.lit(str(before)).cast("date"))
    days = [r.day for r in changes.filter("NOT folded").select("day").distinct().collect()]
    if days:
        folded = _folded(changes.filter(F.col("day").isin(days)))
        _replace_days(folded.withColumns({"folded": F.lit(True), "day": F.to_date("hour_bucket")}), path, ROLLUP_KEY)


def refresh_rollup(
    keyed: DataFrame,
    path: str,
    days: Sequence[dt.date | str] | None = None,
    high_values: Sequence[str] = HIGH_VALUES,
) -> None:
    """Rebuild the rollup at ``path`` from the keyed table, all of it or only some days.

    Replaces the folders of the days it writes, so it can be repeated at any
    interval.
    """
    if days is not None:
        keyed = keyed.filter(F.to_date("timestamp").isin([dt.date.fromisoformat(str(d)) for d in days]))
    rollup = anomaly_rollup(keyed, high_values).withColumn("day", F.to_date("hour_bucket"))
    (
        rollup.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if days is None else "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
