"""The queries in plain SQL for DuckDB, written independently of the Spark plans.

Doubles are rounded as ``round(x * 10^d) / 10^d`` on both sides; where the result
can be zero from below, ``+ 0`` drops the sign that Spark's ``round`` does not
keep. Dates and lists are shown as text.
"""

from __future__ import annotations

from workloads.views import with_views

ORACLE: dict[str, str] = {}

SHOP = ["customers", "geolocation", "sellers", "products", "orders_b", "order_items", "payments", "reviews"]

SHOP_TABLES = """,
orders_fct AS (
  SELECT o.order_id, o.customer_id, o.order_status, p.payment_value, o.order_purchase_timestamp, r.review_score
  FROM orders_b o JOIN customers c ON c.customer_id = o.customer_id
  LEFT JOIN payments p ON p.order_id = o.order_id LEFT JOIN reviews r ON r.order_id = o.order_id),
order_items_fct AS (
  SELECT i.order_id, i.product_id, i.seller_id, i.price, i.freight_value, i.product_quantity,
    i.shipping_limit_date, p.product_category_name, p.product_weight_g, p.product_length_cm,
    p.product_height_cm, p.product_width_cm, s.seller_city, s.seller_state
  FROM order_items i LEFT JOIN products p ON p.product_id = i.product_id
  LEFT JOIN sellers s ON s.seller_id = i.seller_id),
customers_dim AS (
  SELECT c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix,
    g.geolocation_city AS customer_city, g.geolocation_state AS customer_state
  FROM customers c LEFT JOIN geolocation g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix),
sellers_dim AS (
  SELECT s.seller_id, s.seller_zip_code_prefix, g.geolocation_city AS seller_city,
    g.geolocation_state AS seller_state
  FROM sellers s LEFT JOIN geolocation g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix),
sales_summary AS (
  SELECT o.order_id, o.customer_id, i.product_id, i.seller_id, o.order_status, o.order_purchase_timestamp,
    o.review_score, o.payment_value, i.price, i.freight_value, i.product_quantity, c.customer_city,
    c.customer_state, i.seller_city, i.seller_state, i.product_category_name
  FROM orders_fct o LEFT JOIN order_items_fct i ON i.order_id = o.order_id
  LEFT JOIN customers_dim c ON c.customer_id = o.customer_id
  LEFT JOIN sellers_dim s ON s.seller_id = i.seller_id
  LEFT JOIN products p ON p.product_id = i.product_id),
summary AS (
  SELECT customer_id, count(order_id) AS total_orders, count(DISTINCT order_id) AS distinct_orders,
    round(coalesce(sum(payment_value), 0) * 100) / 100 AS total_spent,
    avg(review_score) AS average_review_score, max(order_purchase_timestamp) AS recency_of_last_order
  FROM sales_summary GROUP BY customer_id)
"""


def _shop(body: str) -> str:
    return with_views(SHOP, SHOP_TABLES + body)


for _name in ("orders_fct", "order_items_fct", "customers_dim", "sellers_dim", "sales_summary"):
    ORACLE[_name] = _shop(f"SELECT * FROM {_name}")

ORACLE["products_dim"] = _shop("SELECT * FROM products")

_SUMMARY = """SELECT s.customer_id, s.{count} AS total_orders, s.total_spent, s.average_review_score,
  s.recency_of_last_order, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state
FROM summary s LEFT JOIN customers_dim c ON c.customer_id = s.customer_id"""
ORACLE["customer_sales_summary"] = _shop(_SUMMARY.format(count="total_orders"))
ORACLE["customer_sales_summary_distinct"] = _shop(_SUMMARY.format(count="distinct_orders"))
ORACLE["wap_publish_dag"] = ORACLE["customer_sales_summary"]

ORACLE["sellers_dim_pruned"] = _shop(
    """SELECT s.seller_id, s.seller_zip_code_prefix, g.geolocation_state
FROM sellers s LEFT JOIN geolocation g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix"""
)
ORACLE["lake_roundtrip"] = "SELECT * FROM orders UNION ALL SELECT * FROM orders"
ORACLE["sales_summary_hot"] = ORACLE["sales_summary"]
ORACLE["wap_publish_fail"] = _shop(
    """SELECT place, order_status, count(*) AS n,
  count(CASE WHEN place = 'target' OR order_status <> 'P' THEN order_id END) AS named
FROM orders_fct, (VALUES ('target'), ('staging')) places(place) GROUP BY place, order_status"""
)
ORACLE["wap_publish_batch_scope"] = _shop("SELECT * FROM customers_dim UNION ALL SELECT * FROM customers_dim")
ORACLE["wap_publish_pass"] = _shop("SELECT * FROM orders_fct UNION ALL SELECT * FROM orders_fct")

ORACLE["null_audit"] = _shop(
    " UNION ALL ".join(
        f"SELECT 'no_nulls' AS \"check\", '{c}' AS subject, count(*) - count({c}) AS failures FROM orders_fct"
        for c in (
            "order_id",
            "customer_id",
            "order_status",
            "payment_value",
            "order_purchase_timestamp",
            "review_score",
        )
    )
)
ORACLE["null_audit_first_column"] = _shop(
    """SELECT 'no_nulls' AS "check", 'order_id' AS subject, count(*) - count(order_id) AS failures FROM orders_fct"""
)
ORACLE["expect_no_nulls"] = _shop(
    """SELECT 'no_nulls' AS "check", 'customer_state' AS subject,
  count(*) - count(customer_state) AS failures FROM customers_dim"""
)
ORACLE["expect_unique_rows"] = _shop(
    """SELECT 'unique_rows' AS "check", 'product_id, seller_id, product_quantity' AS subject, count(*) AS failures
FROM (SELECT 1 FROM order_items_fct GROUP BY product_id, seller_id, product_quantity HAVING count(*) > 1) d"""
)

# --- devices -----------------------------------------------------------------

IOT = ["telemetry", "iot_events"]

IOT_TABLES = """,
events_enforced AS (
  SELECT device_id, cast(event_timestamp AS timestamp) AS event_timestamp, event_type, severity,
    cast(NULL AS varchar) AS error_code, component, cast(NULL AS varchar) AS root_cause,
    cast(NULL AS varchar) AS technician, duration_min, cast(NULL AS varchar) AS parts_replaced,
    cast(NULL AS varchar) AS status, cast(NULL AS bigint) AS next_inspection_days
  FROM iot_events),
silver_events AS (
  SELECT *, cast(event_timestamp AS date) AS event_date, event_type = 'failure' AS is_failure,
    event_type = 'maintenance' AS is_maintenance,
    coalesce(date_sub('day', lag(event_timestamp) OVER (PARTITION BY device_id ORDER BY event_timestamp,
      event_type, severity), event_timestamp), 0) AS days_since_last_event
  FROM events_enforced),
limits AS (
  SELECT avg(temperature) + 2 * stddev_samp(temperature) AS t, avg(energy_usage) + 2 * stddev_samp(energy_usage) AS e
  FROM telemetry),
silver_telemetry AS (
  SELECT event_id, device_id, cast(timestamp AS timestamp) AS timestamp, energy_usage, temperature, vibration,
    signal_strength, cast(timestamp AS date) AS date,
    cast(extract(hour FROM cast(timestamp AS timestamp)) AS integer) AS hour,
    vibration > 3 AS is_vibration_anomaly, temperature > limits.t AS is_temp_anomaly,
    energy_usage > limits.e AS is_energy_spike,
    round((cast(0.4 AS double) * (1 - temperature / cast(30 AS double))
      + cast(0.3 AS double) * (1 - vibration / cast(5 AS double))
      + cast(0.3 AS double) * (cast(signal_strength AS double) / cast(100 AS double))) * 100) / 100
      + cast(0 AS double) AS composite_health_score
  FROM telemetry, limits),
telemetry_daily AS (
  SELECT device_id, date, round(avg(energy_usage) * 100) / 100 AS avg_energy, max(temperature) AS max_temp,
    min(composite_health_score) AS min_health_score,
    count(*) FILTER (WHERE is_vibration_anomaly) AS vibration_anomalies,
    count(*) FILTER (WHERE is_temp_anomaly) AS temp_anomalies, avg(signal_strength) AS avg_signal_strength
  FROM silver_telemetry GROUP BY device_id, date),
failure_stats AS (
  SELECT device_id, event_date, count(*) AS failures_count,
    string_agg(DISTINCT component, ',' ORDER BY component) AS failed_components
  FROM silver_events WHERE is_failure GROUP BY device_id, event_date),
maintenance_impact AS (
  SELECT device_id, max(event_date) AS last_maintenance_date, avg(duration_min) AS avg_maintenance_duration
  FROM silver_events WHERE is_maintenance GROUP BY device_id),
device_health AS (
  SELECT t.*, coalesce(f.failures_count, 0) AS failures_count, coalesce(f.failed_components, '') AS failed_components,
    m.last_maintenance_date, m.avg_maintenance_duration,
    cast(coalesce(date_diff('day', m.last_maintenance_date, t.date), 999) AS integer) AS days_since_maintenance
  FROM telemetry_daily t LEFT JOIN failure_stats f ON f.device_id = t.device_id AND f.event_date = t.date
  LEFT JOIN maintenance_impact m ON m.device_id = t.device_id)
"""

PREDICTION = """,
lookback AS (
  SELECT device_id, count(*) FILTER (WHERE is_vibration_anomaly) AS anomalies_7d,
    round(avg(temperature) * 10) / 10 AS avg_temp_7d, max(energy_usage) AS peak_energy_7d,
    min(composite_health_score) AS worst_health_score_7d
  FROM silver_telemetry WHERE date >= date '{day}' - 60 GROUP BY device_id),
today AS (
  SELECT device_id, count(*) FILTER (WHERE is_vibration_anomaly) AS anomalies_24h, max(temperature) AS peak_temp_24h
  FROM silver_telemetry WHERE date = date '{day}' GROUP BY device_id),
scored AS (
  SELECT l.*, t.anomalies_24h, t.peak_temp_24h,
    round((cast(0.3 AS double) * cast(t.anomalies_24h AS double) / cast(10 AS double)
      + cast(0.4 AS double) * t.peak_temp_24h / cast(30 AS double)
      + cast(0.2 AS double) * (1 - l.worst_health_score_7d)
      + cast(0.1 AS double) * l.peak_energy_7d / cast(5 AS double)) * 100) / 100 AS failure_risk_score,
    '{day}' AS prediction_date
  FROM lookback l LEFT JOIN today t ON t.device_id = l.device_id),
failure_prediction AS (
  SELECT *, CASE WHEN failure_risk_score > 0.8 THEN 'immediate_shutdown'
    WHEN failure_risk_score > 0.6 THEN 'emergency_maintenance'
    WHEN failure_risk_score > 0.4 THEN 'schedule_maintenance' ELSE 'monitor_only' END AS recommended_action
  FROM scored),
rated AS (
  SELECT h.device_id, h.date, p.failure_risk_score,
    CASE WHEN p.failure_risk_score > 0.7 THEN 'P0' WHEN h.days_since_maintenance > 90 THEN 'P1'
         WHEN h.vibration_anomalies > 5 THEN 'P2' ELSE 'P3' END AS priority
  FROM device_health h JOIN failure_prediction p ON p.device_id = h.device_id)
"""


def _iot(body: str) -> str:
    return with_views(IOT, IOT_TABLES + body)


ORACLE["events_enforced"] = _iot("SELECT * FROM events_enforced")
ORACLE["guard_non_empty"] = _iot("SELECT * FROM telemetry")
ORACLE["silver_events"] = _iot(
    "SELECT * REPLACE (cast(event_date AS varchar) AS event_date) FROM silver_events"
)
ORACLE["silver_telemetry"] = _iot("SELECT * REPLACE (cast(date AS varchar) AS date) FROM silver_telemetry")
ORACLE["telemetry_daily"] = _iot("SELECT * REPLACE (cast(date AS varchar) AS date) FROM telemetry_daily")
ORACLE["failure_stats"] = _iot("SELECT * REPLACE (cast(event_date AS varchar) AS event_date) FROM failure_stats")
ORACLE["maintenance_impact"] = _iot(
    "SELECT * REPLACE (cast(last_maintenance_date AS varchar) AS last_maintenance_date) FROM maintenance_impact"
)
ORACLE["device_health"] = _iot(
    """SELECT * REPLACE (cast(date AS varchar) AS date,
  cast(last_maintenance_date AS varchar) AS last_maintenance_date) FROM device_health"""
)
for _suffix, _day in (("", "2024-01-30"), ("_later", "2024-02-15")):
    _predicted = PREDICTION.format(day=_day)
    ORACLE["failure_prediction" + _suffix] = _iot(_predicted + "SELECT * FROM failure_prediction")
    ORACLE["maintenance_schedule" + _suffix] = _iot(
        _predicted
        + """SELECT device_id, cast(date AS varchar) AS date, priority,
  CASE priority WHEN 'P0' THEN 'within_4_hours' WHEN 'P1' THEN 'within_3_days'
    ELSE 'next_routine_cycle' END AS "window",
  CASE priority WHEN 'P0' THEN 5000 WHEN 'P1' THEN 2000 ELSE 500 END AS estimated_cost, failure_risk_score
FROM rated"""
    )

# --- anomalies: confirmation by its definition, counting over pairs of entries

ANOMALY_TABLES = """,
hits AS (
  SELECT event_id, device_id, cast(timestamp AS timestamp) AS timestamp, 1 AS rule, 'high_energy_usage' AS anomaly_type,
    CASE WHEN energy_usage > 6 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
    'Energy usage ' || cast(energy_usage AS varchar) || chr(8239) || 'kWh (threshold:' || chr(8239) || '4.5)' AS text
  FROM telemetry WHERE energy_usage > 4.5
  UNION ALL
  SELECT event_id, device_id, cast(timestamp AS timestamp), 2, 'high_temperature',
    CASE WHEN temperature > 32 THEN 'CRITICAL' ELSE 'HIGH' END,
    'Temperature ' || cast(temperature AS varchar) || chr(8239) || '°C (threshold:' || chr(8239) || '28)'
  FROM telemetry WHERE temperature > 28
  UNION ALL
  SELECT event_id, device_id, cast(timestamp AS timestamp), 3, 'high_vibration', 'HIGH',
    'Vibration ' || cast(vibration AS varchar) || chr(8239) || 'm/s² (threshold:' || chr(8239) || '3.0)'
  FROM telemetry WHERE vibration > 3
  UNION ALL
  SELECT event_id, device_id, cast(timestamp AS timestamp), 4, 'low_signal', 'MEDIUM',
    'Signal strength ' || cast(signal_strength AS varchar) || '% (threshold:' || chr(8239) || '30)'
  FROM telemetry WHERE signal_strength < 30),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY timestamp, event_id, rule) AS seq,
    row_number() OVER (PARTITION BY event_id ORDER BY rule) AS entry,
    count(*) OVER (PARTITION BY event_id) AS entries
  FROM hits),
similar_entries AS (
  SELECT a.event_id, a.rule, count(*) AS n
  FROM numbered a JOIN numbered h ON h.device_id = a.device_id AND h.rule = a.rule AND h.seq <= a.seq
    AND h.seq > a.seq - a.entry - 20 AND a.timestamp - h.timestamp <= INTERVAL 1 HOUR
  GROUP BY a.event_id, a.rule),
rules AS (
  SELECT device_id, timestamp, anomaly_type, severity, text AS description, false AS is_confirmed,
    cast(NULL AS varchar) AS confirmed_by, event_id AS message_id, cast(entry AS integer) AS entry,
    cast(entries AS integer) AS entries
  FROM numbered),
confirmed AS (
  SELECT a.device_id, a.timestamp, a.anomaly_type, a.severity,
    a.text || CASE WHEN s.n >= 3 THEN ' (Auto' || chr(8209) || 'Confirmed)' ELSE '' END AS description,
    s.n >= 3 AS is_confirmed, CASE WHEN s.n >= 3 THEN 'system' END AS confirmed_by,
    a.event_id AS message_id, cast(a.entry AS integer) AS entry, cast(a.entries AS integer) AS entries
  FROM numbered a JOIN similar_entries s ON s.event_id = a.event_id AND s.rule = a.rule),
latest AS (
  SELECT device_id, timestamp, anomaly_type, severity, description, is_confirmed, confirmed_by
  FROM (SELECT *, row_number() OVER (PARTITION BY device_id, timestamp ORDER BY message_id DESC, entry DESC) AS r
        FROM confirmed) x WHERE r = 1)
"""


def _anomalies(body: str) -> str:
    return with_views(IOT, IOT_TABLES + ANOMALY_TABLES + body)


ORACLE["anomalies_rules"] = _anomalies("SELECT * FROM rules")
ORACLE["anomalies_confirmed"] = _anomalies("SELECT * FROM confirmed")
ORACLE["anomalies_latest"] = _anomalies("SELECT * FROM latest")

_ROLLUP = """SELECT device_id, date_trunc('hour', timestamp) AS hour_bucket, count(*) AS total_anomalies,
  count(*) FILTER (WHERE NOT is_confirmed) AS unconfirmed_count,
  count(*) FILTER (WHERE severity IN ({high})) AS high_severity_count,
  string_agg(DISTINCT anomaly_type, ',' ORDER BY anomaly_type) AS anomaly_types
FROM latest GROUP BY 1, 2"""
ORACLE["anomaly_rollup"] = _anomalies(_ROLLUP.format(high="'high'"))
ORACLE["anomaly_rollup_severe"] = _anomalies(_ROLLUP.format(high="'HIGH', 'CRITICAL'"))
ORACLE["unified_device_health"] = _anomalies(
    """SELECT b.device_id, cast(b.date AS varchar) AS date, b.min_health_score AS health_score,
  b.days_since_maintenance,
  count(*) FILTER (WHERE NOT s.is_confirmed) AS pending_anomalies,
  count(*) FILTER (WHERE NOT s.is_confirmed AND s.severity = 'high') AS urgent_anomalies,
  round(((1 - b.min_health_score) * cast(0.6 AS double)
    + cast(least(count(*) FILTER (WHERE NOT s.is_confirmed), 10) AS double) / cast(10 AS double) * cast(0.3 AS double)
    + CASE WHEN b.days_since_maintenance > 90 THEN cast(0.1 AS double) ELSE cast(0 AS double) END) * 100) / 100
    AS criticality_score,
  CASE WHEN (1 - b.min_health_score) > cast(0.7 AS double) OR b.days_since_maintenance > 120 THEN 'P0'
       WHEN (1 - b.min_health_score) > cast(0.5 AS double) OR b.days_since_maintenance > 90 THEN 'P1'
       WHEN b.vibration_anomalies > 5 OR b.temp_anomalies > 3 THEN 'P2' ELSE 'P3' END AS priority
FROM device_health b LEFT JOIN latest s ON s.device_id = b.device_id AND date_trunc('day', s.timestamp) = b.date
GROUP BY b.device_id, b.date, b.min_health_score, b.days_since_maintenance, b.vibration_anomalies, b.temp_anomalies"""
)
ORACLE["stream_anomalies"] = ORACLE["anomalies_confirmed"]
ORACLE["stream_anomalies_upsert"] = ORACLE["anomalies_latest"]
ORACLE["stream_rollup"] = ORACLE["anomaly_rollup"]

# --- files and messages ------------------------------------------------------

ORACLE["scan_partitioned"] = with_views(
    ["telemetry"],
    """SELECT event_id, timestamp, energy_usage, temperature, vibration, signal_strength,
  cast(cast(timestamp AS date) AS varchar) AS date, device_id FROM telemetry""",
)

ORACLE["silver_events_hot"] = ORACLE["silver_events"]
ORACLE["csv_folder"] = with_views(
    ["customers", "sellers"],
    """SELECT customer_id AS id, customer_city AS place FROM customers
UNION ALL SELECT seller_id, seller_city FROM sellers""",
)
ORACLE["path_roundtrip"] = with_views(["orders_b"], "SELECT * FROM orders_b")

ORACLE["scan_damaged"] = with_views(["telemetry"], "SELECT 'damaged.parquet' AS file, count(*) AS n_rows FROM telemetry")

ORACLE["listings_parse"] = with_views(
    ["listings"],
    """SELECT id, price, trim(p[1]) AS description,
  CASE WHEN rated THEN trim(replace(trim(p[2]), '★', '')) END AS reviews,
  trim(p[CASE WHEN rated THEN 3 ELSE 2 END]) AS bedrooms,
  trim(p[CASE WHEN rated THEN 4 ELSE 3 END]) AS beds,
  trim(p[CASE WHEN rated THEN 5 ELSE 4 END]) AS baths
FROM (SELECT cast(id AS integer) AS id, price, string_split(name, '·') AS p,
        coalesce(starts_with(trim(string_split(name, '·')[2]), '★'), false) AS rated
      FROM listings) x""",
)

_KIND = """CASE WHEN event_id % 101 = 5 THEN 'broken' WHEN event_id % 103 = 7 THEN 'anonymous'
  WHEN event_id % 107 = 9 THEN 'astray' WHEN event_id % 109 = 3 THEN 'nameless' WHEN event_id % 113 = 8 THEN 'misfit'
  WHEN event_id % 11 = 6 THEN 'wordy' WHEN event_id % 7 = 3 THEN 'pair' ELSE 'plain' END AS kind"""
_FIRMWARE = "CASE kind WHEN 'wordy' THEN 'v2' END AS firmware"
MESSAGES = f""",
t AS (SELECT *, {_KIND} FROM telemetry),
e AS (SELECT *, {_KIND} FROM iot_events),
t_stored AS (
  SELECT device_id, timestamp, energy_usage, temperature, vibration, signal_strength, {_FIRMWARE}
  FROM t WHERE kind IN ('pair', 'plain', 'wordy')
  UNION ALL
  SELECT device_id || '_spare', timestamp, energy_usage, temperature, vibration, signal_strength, NULL
  FROM t WHERE kind = 'pair'),
e_stored AS (
  SELECT device_id, event_timestamp, event_type, severity, component,
    duration_min, {_FIRMWARE}
  FROM e WHERE kind IN ('pair', 'plain', 'wordy')
  UNION ALL
  SELECT device_id || '_spare', event_timestamp, event_type, severity, component, duration_min, NULL
  FROM e WHERE kind = 'pair'),
rejected AS (
  SELECT CASE kind WHEN 'astray' THEN 'iot-debug' ELSE topic END AS topic, device_id AS "key",
    CASE kind WHEN 'broken' THEN 'bad_json' WHEN 'anonymous' THEN 'missing_device_id'
      WHEN 'nameless' THEN 'missing_device_id' WHEN 'misfit' THEN 'bad_value: ' || number
      ELSE 'unknown_topic' END AS reason
  FROM (SELECT 'iot-telemetry' AS topic, device_id, kind, 'signal_strength' AS number FROM t
        UNION ALL SELECT 'iot-events', device_id, kind, 'duration_min' FROM e) m
  WHERE kind IN ('broken', 'anonymous', 'astray', 'nameless', 'misfit'))
"""
ORACLE["ingest_telemetry"] = with_views(IOT, MESSAGES + "SELECT * FROM t_stored")
ORACLE["ingest_events"] = with_views(IOT, MESSAGES + "SELECT * FROM e_stored")
ORACLE["ingest_rejects"] = with_views(IOT, MESSAGES + "SELECT * FROM rejected")
ORACLE["stream_ingest"] = with_views(
    IOT,
    MESSAGES
    + """SELECT 'telemetry' AS kind, device_id, timestamp AS detail FROM t_stored
UNION ALL SELECT 'events', device_id, event_timestamp FROM e_stored
UNION ALL SELECT 'rejects', "key", reason FROM rejected""",
)

ORACLE["stream_ingest_compacted"] = ORACLE["stream_ingest"]

for _name in ("silver_telemetry", "failure_prediction", "silver_events"):
    ORACLE[f"{_name}_days"] = ORACLE[_name]
