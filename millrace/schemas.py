"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE, _INT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
_TIME = T.TimestampNTZType()


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# --- device messages ---------------------------------------------------------

TELEMETRY = struct_of(
    device_id=_STRING,
    timestamp=_STRING,
    energy_usage=_DOUBLE,
    temperature=_DOUBLE,
    vibration=_DOUBLE,
    signal_strength=_INT,
)

# As they arrive: the time is still text.
EVENTS_RAW = struct_of(
    device_id=_STRING,
    event_timestamp=_STRING,
    event_type=_STRING,
    severity=_STRING,
    error_code=_STRING,
    component=_STRING,
    root_cause=_STRING,
    technician=_STRING,
    duration_min=_LONG,
    parts_replaced=_STRING,
    status=_STRING,
    next_inspection_days=_LONG,
)

# The fixed twelve columns every batch of events is brought to.
EVENTS = T.StructType(
    [T.StructField(f.name, _TIME if f.name == "event_timestamp" else f.dataType) for f in EVENTS_RAW]
)

ANOMALIES = struct_of(
    device_id=_STRING,
    timestamp=_TIME,
    anomaly_type=_STRING,
    severity=_STRING,
    description=_STRING,
    is_confirmed=T.BooleanType(),
    confirmed_by=_STRING,
)

# One broker message: the payload is JSON text, an object or an array of them.
ENVELOPE = struct_of(topic=_STRING, key=_STRING, value=_STRING)

TELEMETRY_TOPIC = "iot-telemetry"
EVENTS_TOPIC = "iot-events"
ANOMALIES_TOPIC = "iot-anomalies"

# --- e-commerce bronze -------------------------------------------------------

BRONZE = {
    "customers": struct_of(
        customer_id=_STRING,
        customer_unique_id=_STRING,
        customer_zip_code_prefix=_STRING,
        customer_city=_STRING,
        customer_state=_STRING,
    ),
    "orders": struct_of(
        order_id=_STRING,
        customer_id=_STRING,
        order_status=_STRING,
        order_purchase_timestamp=_TIME,
        order_approved_at=_TIME,
        order_delivered_carrier_date=_TIME,
        order_delivered_customer_date=_TIME,
        order_estimated_delivery_date=_TIME,
    ),
    "order_items": struct_of(
        order_id=_STRING,
        product_id=_STRING,
        seller_id=_STRING,
        shipping_limit_date=_TIME,
        price=_DOUBLE,
        freight_value=_DOUBLE,
        order_item_id=_INT,
        product_quantity=_INT,
    ),
    "order_payments": struct_of(
        order_id=_STRING,
        payment_sequential=_INT,
        payment_type=_STRING,
        payment_installments=_INT,
        payment_value=_DOUBLE,
    ),
    "order_reviews": struct_of(
        review_id=_STRING,
        order_id=_STRING,
        review_score=_INT,
        review_comment_title=_STRING,
        review_comment_message=_STRING,
        review_creation_date=_TIME,
        review_answer_timestamp=_TIME,
    ),
    "products": struct_of(
        product_id=_STRING,
        product_category_name=_STRING,
        product_name_length=_INT,
        product_description_length=_INT,
        product_weight_g=_INT,
        product_length_cm=_INT,
        product_height_cm=_INT,
        product_width_cm=_INT,
    ),
    "sellers": struct_of(
        seller_id=_STRING,
        seller_zip_code_prefix=_STRING,
        seller_city=_STRING,
        seller_state=_STRING,
    ),
    "geolocation": struct_of(
        geolocation_zip_code_prefix=_STRING,
        geolocation_lat=T.DecimalType(9, 6),
        geolocation_lng=T.DecimalType(9, 6),
        geolocation_city=_STRING,
        geolocation_state=_STRING,
    ),
}
