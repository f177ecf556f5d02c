"""Orders, items, customers, sellers and products: silver facts and dims, gold summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import HotLimits, left_join


def orders_fct(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame, hot: bool | HotLimits = True
) -> DataFrame:
    """Orders of known customers, one row per payment and review of the order."""
    known = orders.join(customers.select("customer_id"), "customer_id", "inner")
    paid = left_join(known, payments.select("order_id", "payment_value"), ["order_id"], split_hot=hot)
    rated = left_join(paid, reviews.select("order_id", "review_score"), ["order_id"], split_hot=hot)
    return rated.select(
        "order_id",
        "customer_id",
        "order_status",
        "payment_value",
        "order_purchase_timestamp",
        "review_score",
    )


def order_items_fct(order_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Order items with the measures of their product and the place of their seller."""
    described = left_join(order_items, products, ["product_id"])
    return left_join(described, sellers, ["seller_id"]).select(
        "order_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        "product_quantity",
        "shipping_limit_date",
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "seller_city",
        "seller_state",
    )


def customers_dim(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Customers with city and state looked up by zip prefix."""
    located = left_join(customers, geolocation, {"customer_zip_code_prefix": "geolocation_zip_code_prefix"})
    return located.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        F.col("geolocation_city").alias("customer_city"),
        F.col("geolocation_state").alias("customer_state"),
    )


def _located_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return left_join(sellers, geolocation, {"seller_zip_code_prefix": "geolocation_zip_code_prefix"})


def sellers_dim(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sellers with city and state looked up by zip prefix."""
    return _located_sellers(sellers, geolocation).select(
        "seller_id",
        "seller_zip_code_prefix",
        F.col("geolocation_city").alias("seller_city"),
        F.col("geolocation_state").alias("seller_state"),
    )


def sellers_dim_pruned(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """The narrow seller dimension of the declared models: zip prefix and state."""
    return _located_sellers(sellers, geolocation).select(
        "seller_id", "seller_zip_code_prefix", "geolocation_state"
    )


def products_dim(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def sales_summary(
    orders_fct: DataFrame,
    order_items_fct: DataFrame,
    customers_dim: DataFrame,
    sellers_dim: DataFrame,
    products_dim: DataFrame,
    order_items: DataFrame | None = None,
    hot: bool | HotLimits = True,
) -> DataFrame:
    """Every order row with its items and the customer's place.

    Seller place and product category are those of the items; the seller and
    product dims only multiply rows where they repeat a key. If
    ``order_items_fct`` is not stored but a plan, pass the ``order_items`` it is
    made from: orders with very many items are looked for there.
    """
    sold = left_join(orders_fct, order_items_fct, ["order_id"], split_hot=hot, look_in=order_items)
    sold = left_join(sold, customers_dim, ["customer_id"])
    sold = left_join(sold, sellers_dim, ["seller_id"])
    sold = left_join(sold, products_dim, ["product_id"])
    return sold.select(
        "order_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_status",
        "order_purchase_timestamp",
        "review_score",
        "payment_value",
        "price",
        "freight_value",
        "product_quantity",
        "customer_city",
        "customer_state",
        "seller_city",
        "seller_state",
        "product_category_name",
    )


def customer_sales_summary(
    sales_summary: DataFrame, customers_dim: DataFrame, distinct_orders: bool = False
) -> DataFrame:
    """Orders, spending, mean rating and last order per customer.

    By default ``total_orders`` counts the rows of the sales table, so an order
    counts once per item, payment and review; ``distinct_orders=True`` counts
    orders. ``total_spent`` adds up the same rows.
    """
    orders = F.count_distinct("order_id") if distinct_orders else F.count("order_id")
    totals = sales_summary.groupBy("customer_id").agg(
        orders.alias("total_orders"),
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_spent"),
        F.avg("review_score").alias("average_review_score"),
        F.max("order_purchase_timestamp").alias("recency_of_last_order"),
    )
    return left_join(totals, customers_dim, ["customer_id"])
