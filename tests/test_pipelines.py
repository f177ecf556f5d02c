import datetime as dt

import pytest

from millrace.operators import AuditError
from millrace.plans.pipelines import GOLD_MODELS, SILVER_MODELS, publish_bronze, run_gold, run_silver
from millrace.plans.publish import publish_dag
from millrace.schemas import BRONZE
from millrace.sources import frame_from_columns
from tests.helpers import rows

NOW = dt.datetime(2024, 1, 1)


@pytest.fixture()
def bronze(spark):
    data = {
        "customers": {"customer_id": ["c1"], "customer_unique_id": ["u"], "customer_zip_code_prefix": ["z"], "customer_city": ["x"], "customer_state": ["x"]},
        "orders": {"order_id": ["o1", "o2"], "customer_id": ["c1", "c1"], "order_status": ["new", "new"], "order_purchase_timestamp": [NOW, NOW],
                   "order_approved_at": [NOW] * 2, "order_delivered_carrier_date": [NOW] * 2, "order_delivered_customer_date": [None] * 2, "order_estimated_delivery_date": [NOW] * 2},
        "order_items": {"order_id": ["o1"], "product_id": ["p"], "seller_id": ["s"], "shipping_limit_date": [NOW], "price": [2.0], "freight_value": [0.5], "order_item_id": [1], "product_quantity": [3]},
        "order_payments": {"order_id": ["o1", "o1"], "payment_sequential": [1, 2], "payment_type": ["card"] * 2, "payment_installments": [1, 1], "payment_value": [5.0, 6.0]},
        "order_reviews": {"review_id": ["r"], "order_id": ["o1"], "review_score": [4], "review_comment_title": [None], "review_comment_message": [None], "review_creation_date": [NOW], "review_answer_timestamp": [NOW]},
        "products": {"product_id": ["p"], "product_category_name": ["toys"], "product_name_length": [1], "product_description_length": [1], "product_weight_g": [1], "product_length_cm": [1], "product_height_cm": [1], "product_width_cm": [1]},
        "sellers": {"seller_id": ["s"], "seller_zip_code_prefix": ["z"], "seller_city": ["own"], "seller_state": ["own"]},
        "geolocation": {"geolocation_zip_code_prefix": ["z"], "geolocation_lat": [None], "geolocation_lng": [None], "geolocation_city": ["city"], "geolocation_state": ["state"]},
    }
    return {name: frame_from_columns(spark, columns, BRONZE[name]) for name, columns in data.items()}


def test_layers(spark, bronze, namespace):
    publish_bronze(spark, bronze, namespace)
    silver = run_silver(spark, namespace, namespace)
    assert {n: t.count() for n, t in silver.items()} == {
        "orders_fct": 3, "order_items_fct": 1, "sellers_dim": 1, "customers_dim": 1, "products_dim": 1
    }
    gold = run_gold(spark, namespace, namespace)
    assert rows(gold["customer_sales_summary"], "customer_id", "total_orders", "total_spent", "average_review_score", "customer_city") == {
        ("c1", 3, 11.0, 4.0, "city"): 1
    }


def test_declared_models(spark, bronze, namespace):
    for _ in range(2):
        out = publish_dag(spark, SILVER_MODELS | GOLD_MODELS, bronze, namespace)
    assert out["sellers_dim"].columns == ["seller_id", "seller_zip_code_prefix", "geolocation_state"]
    assert rows(out["customer_sales_summary"], "customer_id", "total_orders") == {("c1", 3): 1}


def test_declared_expectations_stop_the_run(spark, bronze, namespace):
    bronze["customers"] = bronze["customers"].unionAll(bronze["customers"])
    with pytest.raises(AuditError, match="unique_rows"):
        publish_dag(spark, SILVER_MODELS | GOLD_MODELS, bronze, namespace)
    assert not spark.catalog.tableExists(f"{namespace}.orders_fct")
