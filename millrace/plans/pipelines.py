"""The layer-by-layer runs: what reads which tables and publishes which."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quality import NoNulls, expect_unique_rows, require_rows
from millrace.plans import ecommerce, incremental, iot, serving
from millrace.plans.listings import listings_parse
from millrace.plans.publish import Model, publish_layer
from millrace.schemas import EVENTS, EVENTS_RAW, TELEMETRY
from millrace.session import remove_path, scratch_dir, written
from millrace.sources.files import enforce_schema, load_csv_folder, scan_partitioned
from millrace.sources.tables import create_namespace, layer_name, read_layer, replace_table

BRONZE_TABLES = (
    "customers",
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "sellers",
    "geolocation",
)


def publish_bronze(spark: SparkSession, tables: Mapping[str, DataFrame], namespace: str) -> dict[str, DataFrame]:
    """Publish raw tables as ``name_bronze``; a repeated run appends again."""
    create_namespace(spark, namespace)
    return publish_layer(tables, namespace, "bronze")


def run_silver(spark: SparkSession, bronze: str, silver: str) -> dict[str, DataFrame]:
    """Facts and dims from the bronze tables."""
    raw = {name: read_layer(spark, bronze, name, "bronze") for name in BRONZE_TABLES}
    create_namespace(spark, silver)
    tables = {
        "orders_fct": ecommerce.orders_fct(
            raw["orders"], raw["customers"], raw["order_payments"], raw["order_reviews"]
        ),
        "order_items_fct": ecommerce.order_items_fct(raw["order_items"], raw["products"], raw["sellers"]),
        "sellers_dim": ecommerce.sellers_dim(raw["sellers"], raw["geolocation"]),
        "customers_dim": ecommerce.customers_dim(raw["customers"], raw["geolocation"]),
        "products_dim": ecommerce.products_dim(raw["products"]),
    }
    return publish_layer(tables, silver, "silver")


def run_gold(spark: SparkSession, silver: str, gold: str) -> dict[str, DataFrame]:
    """The sales table, then the customer summary read from what was published."""
    create_namespace(spark, gold)
    names = ("orders_fct", "order_items_fct", "customers_dim", "sellers_dim", "products_dim")
    tables = {name: read_layer(spark, silver, name, "silver") for name in names}
    sales = ecommerce.sales_summary(*[tables[n] for n in names])
    published = publish_layer({"sales_summary": sales}, gold, "gold")
    summary = ecommerce.customer_sales_summary(published["sales_summary"], tables["customers_dim"])
    return published | publish_layer({"customer_sales_summary": summary}, gold, "gold")


# The same tables as declared models, each replaced as a whole.
SILVER_MODELS = {
    "sellers_dim": Model(ecommerce.sellers_dim_pruned, ("sellers", "geolocation")),
    "customers_dim": Model(
        ecommerce.customers_dim,
        ("customers", "geolocation"),
        audits=(NoNulls(("customer_id",)), expect_unique_rows),
    ),
    "products_dim": Model(ecommerce.products_dim, ("products",)),
    "orders_fct": Model(ecommerce.orders_fct, ("orders", "customers", "order_payments", "order_reviews")),
    "order_items_fct": Model(ecommerce.order_items_fct, ("order_items", "products", "sellers")),
}

GOLD_MODELS = {
    "sales_summary": Model(
        ecommerce.sales_summary,
        ("orders_fct", "order_items_fct", "customers_dim", "sellers_dim", "products_dim"),
    ),
    "customer_sales_summary": Model(
        ecommerce.customer_sales_summary,
        ("sales_summary", "customers_dim"),
        audits=(NoNulls(("customer_id",)),),
    ),
}


def load_iot(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(events, telemetry) from the ingested folders; neither may be empty."""
    events = enforce_schema(scan_partitioned(spark, root, "events", EVENTS_RAW), EVENTS, {"event_timestamp"})
    telemetry = scan_partitioned(spark, root, "telemetry", TELEMETRY)
    return require_rows(events, "events"), require_rows(telemetry, "telemetry")


def run_iot_batch(
    spark: SparkSession, root: str, namespace: str, as_of: dt.date | str | None = None
) -> dict[str, DataFrame]:
    """Device health, failure prediction and maintenance plan, published one by one.

    Health and prediction are written once to a scratch folder, since each is
    both published and read for the plan, and the published tables also hold
    the rows of earlier runs. The folder goes when all are published.
    """
    create_namespace(spark, namespace)
    events, telemetry = load_iot(spark, root)
    silver, scratch = iot.silver_telemetry(telemetry), scratch_dir(spark, "iot")
    health = written(iot.device_health(silver, iot.event_flags(events)), f"{scratch}/health")
    prediction = written(iot.failure_prediction(silver, as_of), f"{scratch}/prediction")
    tables = {
        "gold_device_health": health,
        "gold_failure_prediction": prediction,
        "gold_maintenance_schedule": iot.maintenance_schedule(health, prediction),
    }
    published = publish_layer(tables, namespace)
    remove_path(spark, scratch)
    return published


def run_iot_day(spark: SparkSession, root: str, state: str, day: dt.date | str) -> dict[str, DataFrame]:
    """The silver rows of one ingested day and the failure prediction as of it, reading that day's folders only.

    What the results need of other days is kept below ``state``; see
    ``incremental``. A repeated run replaces its own part of it.
    """
    chosen = F.col("date") == F.lit(str(day)).cast("date")
    raw = scan_partitioned(spark, root, "events", EVENTS_RAW).filter(chosen)
    events = enforce_schema(raw, EVENTS, {"event_timestamp"})
    telemetry = require_rows(scan_partitioned(spark, root, "telemetry", TELEMETRY).filter(chosen), f"telemetry of {day}")
    incremental.store_telemetry(telemetry, state, day)
    return {
        "silver_telemetry": incremental.silver_telemetry_of(telemetry, state),
        "silver_events": incremental.silver_events_of(events, state, day),
        "failure_prediction": incremental.failure_prediction_of(spark, state, day),
    }


def refresh_serving(
    spark: SparkSession, keyed_anomalies: DataFrame, gold: str, serving_namespace: str
) -> dict[str, DataFrame]:
    """Rebuild the serving tables from the keyed anomalies and the gold device health."""
    create_namespace(spark, serving_namespace)
    health = read_layer(spark, gold, "gold_device_health")
    tables = {
        "anomaly_rollup": serving.anomaly_rollup(keyed_anomalies),
        "unified_device_health": serving.unified_device_health(health, keyed_anomalies),
    }
    for name, df in tables.items():
        replace_table(df, layer_name(serving_namespace, name))
    return {name: read_layer(spark, serving_namespace, name) for name in tables}


def load_listings(spark: SparkSession, folder: str, namespace: str) -> dict[str, DataFrame]:
    """Every CSV file of a folder as a table, replaced each time; ``listings`` is parsed."""
    create_namespace(spark, namespace)
    tables = load_csv_folder(spark, folder)
    for name, df in tables.items():
        replace_table(listings_parse(df) if name == "listings" else df, layer_name(namespace, name))
    return {name: read_layer(spark, namespace, name) for name in tables}
