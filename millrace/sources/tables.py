"""Catalog tables by namespace, name and layer, and the plain ways to write them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> str:
    """Create the database if it is missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{place}")
    return namespace


def layer_name(namespace: str, name: str, layer: str | None = None) -> str:
    """``namespace.name_layer``, such as ``shop.orders_bronze``."""
    return f"{namespace}.{name}_{layer}" if layer else f"{namespace}.{name}"


def read_layer(spark: SparkSession, namespace: str, name: str, layer: str | None = None) -> DataFrame:
    return spark.table(layer_name(namespace, name, layer))


def read_model(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table input with the columns the reader needs; only those are scanned."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def _writer(df: DataFrame, fmt: str, partition_by: Sequence[str]):
    writer = df.write.format(fmt)
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append, creating the table at first; running it again adds the rows again."""
    _writer(df, fmt, partition_by).mode("append").saveAsTable(table)


def replace_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Create the table or replace its content.

    Three-part names belong to a catalog plug-in, which replaces in one step.
    """
    if table.count(".") >= 2:
        writer = df.writeTo(table).using(fmt)
        if partition_by:
            writer = writer.partitionedBy(*partition_by)
        writer.createOrReplace()
    else:
        _writer(df, fmt, partition_by).mode("overwrite").saveAsTable(table)


def import_parquet(spark: SparkSession, uri: str, table: str) -> DataFrame:
    """Make a table from the Parquet files at ``uri``, replacing one of that name."""
    replace_table(spark.read.parquet(uri), table)
    return spark.table(table)
