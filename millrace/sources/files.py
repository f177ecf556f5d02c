"""Files: partitioned Parquet, any path format, CSV folders, schema enforcement."""

from __future__ import annotations

import os
from collections.abc import Collection, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.layout import spread
from millrace.session import path_exists, ship_package

REGISTER = "path string, length long, modified long, n_rows long"
#: A sound file without rows is hardly more than its footer; larger files that give no row are damaged.
EMPTY_BYTES = 64 << 20


def _places(root: str, prefix: str) -> tuple[str, str]:
    """The folder to look into, and the register of its dataset; readers of ``root`` skip names with an underscore."""
    root, prefix = root.rstrip("/"), prefix.strip("/")
    return f"{root}/{prefix}", f"{root}/_footers/{prefix.split('/')[0]}"


def _files(spark: SparkSession, place: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.parquet").load(place)


def _no_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of the files that are sound and have no rows."""
    import pyarrow.parquet as pq

    for batch in batches:
        sound = []
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            try:
                if pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows == 0:
                    sound.append(path.as_py())
            except (pa.ArrowInvalid, OSError):
                pass
        yield pa.RecordBatch.from_arrays([pa.array(sound, pa.string())], ["path"])


def _examined(spark: SparkSession, place: str, fresh: DataFrame, since: int) -> DataFrame:
    """``fresh`` files (changed at ``since`` or later) with their ``n_rows``; null for damaged ones."""
    # Without data columns only footers are read, and those that fail give no row.
    reader = spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    rows = reader.option("pathGlobFilter", "*.parquet").parquet(place)
    rows = rows.where(F.unix_micros("_metadata.file_modification_time") >= since)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
    counted = fresh.join(counts, "path", "left")
    unclear = [r.path for r in counted.where(F.col("n_rows").isNull() & (F.col("length") <= EMPTY_BYTES)).select("path").collect()]
    if not unclear:
        return counted
    ship_package(spark)
    content = _files(spark, place).where(F.col("_metadata.file_path").isin(unclear))
    empty = content.select(F.col("_metadata.file_path").alias("path"), "content").mapInArrow(_no_rows, "path string")
    counted = counted.join(empty.withColumn("none", F.lit(0).cast("long")), "path", "left")
    return counted.select("path", "length", "modified", F.coalesce("n_rows", "none").alias("n_rows"))


def checked_files(spark: SparkSession, root: str, prefix: str, register: bool = True) -> DataFrame:
    """(path, length, modified, n_rows) of the Parquet files of a dataset; n_rows is null where a footer is damaged.

    Verdicts are kept in a register beside the dataset, so that a footer is read once for each path, length
    and time of change. Without ``register`` nothing is written there, and all footers are read. Only
    the paths of files that give no row come to the driver.
    """
    place, kept = _places(root, prefix)
    meta = {"path": "file_path", "length": "file_size", "modified": "file_modification_time"}
    listed = _files(spark, place).select(*[F.col(f"_metadata.{x}").alias(n) for n, x in meta.items()])
    listed = listed.withColumn("modified", F.unix_micros("modified"))
    known = spark.createDataFrame([], REGISTER)
    if register and path_exists(spark, kept):
        known = spark.read.schema(REGISTER).parquet(kept).dropDuplicates(["path", "length", "modified"])
    fresh = listed.join(known, ["path", "length", "modified"], "left_anti")
    since = fresh.agg(F.min("modified")).first()[0]
    if since is not None:
        verdicts = _examined(spark, place, fresh, since).select("path", "length", "modified", "n_rows")
        if register:
            verdicts.coalesce(1).write.mode("append").parquet(kept)
            known = spark.read.schema(REGISTER).parquet(kept).dropDuplicates(["path", "length", "modified"])
        else:
            known = verdicts
    return listed.join(known, ["path", "length", "modified"])


def damaged_files(spark: SparkSession, root: str, prefix: str, register: bool = True) -> DataFrame:
    """(path) of the files below a dataset whose footer cannot be read; see ``checked_files``."""
    return checked_files(spark, root, prefix, register).where("n_rows IS NULL").select("path")


def scan_partitioned(
    spark: SparkSession,
    root: str,
    prefix: str,
    schema: T.StructType | None = None,
    damaged: str = "skip",
    register: bool = True,
) -> DataFrame:
    """Scan a ``date=.../device_id=...`` Parquet folder without the files that ``damaged_files`` names.

    ``prefix`` is a dataset ("telemetry") or one of its partitions
    ("telemetry/date=2024-01-01"); the partition columns are kept either way.
    Pass the schema of the files to save inference and to keep device ids text
    whatever they look like. Filters on the partition columns prune folders.
    ``damaged`` is "skip", "fail" (raise if there are any) or "trust" (do not
    look). A read error in a sound file always raises: no rows go missing. Files
    without rows are sound. Verdicts are kept beside the dataset if ``register``.
    """
    if damaged not in ("skip", "fail", "trust"):
        raise ValueError(f"unknown choice {damaged!r}")
    dataset, root = prefix.strip("/").split("/")[0], root.rstrip("/")
    skipped = []
    if damaged != "trust":
        skipped = [r.path for r in damaged_files(spark, root, prefix, register).collect()]
        if skipped and damaged == "fail":
            raise ValueError(f"damaged files below {root}/{prefix}, such as {skipped[0]}")
    reader = spark.read.option("basePath", f"{root}/{dataset}")
    if schema is None and skipped:
        one = spark.read.option("ignoreCorruptFiles", "true").option("basePath", f"{root}/{dataset}")
        schema = one.parquet(f"{root}/{prefix.strip('/')}").schema
    if schema is not None:
        names = {"date", "device_id"}
        fields = [f for f in schema.fields if f.name not in names]
        keys = [T.StructField("date", T.DateType()), T.StructField("device_id", T.StringType())]
        reader = reader.schema(T.StructType(fields + keys))
    rows = reader.parquet(f"{root}/{prefix.strip('/')}")
    # A condition on the file name leaves the file out of the scan.
    return rows.filter(~F.col("_metadata.file_path").isin(skipped)) if skipped else rows


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a table stored under a path; ``fmt`` names any format Spark has a source for."""
    return spark.read.format(fmt).options(**options).load(path)


def write_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """Write a table under a path, by default replacing what is there."""
    df.write.format(fmt).mode(mode).options(**options).save(path)


def write_partitioned(
    df: DataFrame,
    root: str,
    dataset: str,
    partition_by: Sequence[str] = ("date", "device_id"),
) -> None:
    """Append a dataset in the layout ``scan_partitioned`` reads, in few files per folder."""
    target = f"{root.rstrip('/')}/{dataset}"
    spread(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(target)


def load_csv_folder(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Every ``.csv`` file of a folder by its base name, header row first.

    A folder called ``.csv`` that holds part files is one table, like a file.
    Types are inferred, which reads a file twice, unless ``schemas`` names the
    table. Only the list of table names comes to the driver.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    below = F.element_at(F.split("path", f"/{os.path.basename(folder.rstrip('/'))}/", -1), -1)
    entries = files.load(folder).select(F.split(below, "/")[0].alias("entry")).distinct()
    tables = {}
    for row in entries.sort("entry").collect():
        name, reader = os.path.splitext(row.entry)[0], spark.read.option("header", "true")
        path = f"{folder.rstrip('/')}/{row.entry}"
        if schemas and name in schemas:
            tables[name] = reader.schema(schemas[name]).csv(path)
        else:
            tables[name] = reader.csv(path, inferSchema=True)
    return tables


def enforce_schema(df: DataFrame, schema: T.StructType, parse: Collection[str] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, in its order.

    Columns the input lacks become typed nulls, others are dropped. Columns in
    ``parse`` hold ISO-8601 text and become timestamps; text that is no time is
    an error.
    """

    def column(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if field.name in parse:
            return F.to_timestamp_ntz(F.col(field.name)).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])
