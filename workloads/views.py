"""Inputs of the library as SQL over the test tables.

One text per view, valid in Spark and DuckDB. ``{k}`` stands for the integer
field ``k`` of ``events.props``, which the two engines extract differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SPARK_K = "cast(get_json_object(props, '$.k') AS int)"
DUCKDB_K = "cast(json_extract_string(props, '$.k') AS int)"

# name -> (tables it reads, SQL)
VIEWS = {
    "customers": (
        ["customer"],
        """SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
             c_nationkey AS customer_zip_code_prefix, 'raw' AS customer_city, 'raw' AS customer_state
           FROM customer""",
    ),
    "geolocation": (
        ["nation", "region"],
        # The places of one region have a prefix that nobody lives in.
        """SELECT CASE WHEN n_regionkey < 4 THEN n_nationkey ELSE n_nationkey + 1000 END AS geolocation_zip_code_prefix,
             n_name AS geolocation_city, r_name AS geolocation_state
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "sellers": (
        ["supplier"],
        """SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
             'city_' || cast(s_nationkey AS string) AS seller_city,
             'st_' || cast(s_nationkey % 5 AS string) AS seller_state
           FROM supplier""",
    ),
    "products": (
        ["part"],
        """SELECT p_partkey AS product_id, p_type AS product_category_name,
             length(p_name) AS product_name_length, length(p_name) * 10 AS product_description_length,
             p_size * 1000 AS product_weight_g, p_size AS product_length_cm,
             p_size + 1 AS product_height_cm, p_size + 2 AS product_width_cm
           FROM part""",
    ),
    "orders_b": (
        ["orders"],
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
             o_orderdate AS order_purchase_timestamp
           FROM orders""",
    ),
    "order_items": (
        ["lineitem"],
        """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
             l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value,
             l_linenumber AS order_item_id, cast(l_quantity AS int) AS product_quantity
           FROM lineitem""",
    ),
    "payments": (
        ["orders"],
        # Finished orders have two payments; those in progress have payments that belong to no order.
        """SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS order_id,
             1 AS payment_sequential, o_totalprice AS payment_value
           FROM orders
           UNION ALL
           SELECT o_orderkey AS order_id, 2 AS payment_sequential, o_totalprice AS payment_value
           FROM orders WHERE o_orderstatus = 'F'""",
    ),
    "reviews": (
        ["orders"],
        # Reviews of one priority belong to no order.
        """SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN -o_orderkey ELSE o_orderkey END AS order_id,
             cast(substr(o_orderpriority, 1, 1) AS int) AS review_score
           FROM orders""",
    ),
    "telemetry": (
        ["events"],
        """SELECT event_id, 'device_' || cast(user_id % 25 AS string) AS device_id,
             cast(ts AS string) AS timestamp, value / cast(60 AS double) AS energy_usage,
             cast(18 AS double) + cast(event_id * 13 % 120 AS double) / cast(10 AS double)
               + CASE WHEN event_id % 50 = 0 THEN cast(10 AS double) ELSE cast(0 AS double) END AS temperature,
             cast(event_id * 29 % 20 AS double) / cast(10 AS double)
               + CASE WHEN event_id % 20 = 7
                        OR (user_id % 25 = 5 AND event_id % 2 = 0 AND ts < timestamp '2024-01-25 00:00:00')
                      THEN cast(3 AS double) ELSE cast(0 AS double) END AS vibration,
             {k} AS signal_strength
           FROM events""",
    ),
    "iot_events": (
        ["events"],
        """SELECT event_id, 'device_' || cast(user_id % 25 AS string) AS device_id,
             cast(ts AS string) AS event_timestamp,
             CASE WHEN event_type = 'error' THEN 'failure'
                  WHEN event_type = 'purchase' AND user_id % 25 NOT IN (3, 8) THEN 'maintenance'
                  ELSE 'inspection' END AS event_type,
             CASE WHEN value > 60 THEN 'high' WHEN value > 20 THEN 'medium' ELSE 'low' END AS severity,
             CASE WHEN event_type = 'error' THEN
               CASE {k} % 4 WHEN 0 THEN 'motor' WHEN 1 THEN 'bearing' WHEN 2 THEN 'sensor'
                            ELSE 'battery' END END AS component,
             CASE WHEN event_type = 'purchase' AND user_id % 25 NOT IN (3, 8)
                  THEN cast(15 + {k} AS bigint) END AS duration_min
           FROM events""",
    ),
    # Packed listing names: with and without rating, complete and cut short.
    "listings": (
        ["part"],
        """SELECT p_partkey AS id,
             p_name || CASE WHEN p_partkey % 3 <> 0
                            THEN ' · ★' || cast(p_size AS string) || '.5' ELSE '' END
               || ' · ' || cast(p_size % 4 + 1 AS string) || ' bedrooms'
               || CASE WHEN p_partkey % 5 <> 0 THEN ' · ' || cast(p_size % 6 + 1 AS string) || ' beds'
                       ELSE '' END
               || CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0
                       THEN ' · ' || cast(p_size % 3 + 1 AS string) || ' baths' ELSE '' END AS name,
             p_brand AS neighbourhood_group, p_retailprice AS price, p_type AS license
           FROM part""",
    ),
}


# Schemas by path, so that only the first read of a table runs a job to infer it.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the Parquet files of ``sf_dir``."""
    reads, sql = VIEWS[name]
    placed = sql.replace("{k}", SPARK_K)
    for read in reads:
        for word in ("FROM", "JOIN"):
            placed = placed.replace(f"{word} {read}", f"{word} {{{read}}}")
    frames = {t: table(spark, sf_dir, t) for t in reads}
    return spark.sql(placed, **frames)


def with_views(names: list[str], body: str) -> str:
    """``body`` for DuckDB, with the named views in front of it."""
    views = [f"{n} AS ({VIEWS[n][1].replace('{k}', DUCKDB_K)})" for n in names]
    return "WITH " + ",\n".join(views) + (",\n" if body.lstrip().startswith(",") else "\n") + body.lstrip().lstrip(",")
