import datetime as dt

from pyspark.sql import functions as F

from millrace.plans.messages import route_messages
from tests.helpers import rows

DAY = dt.date(2024, 1, 1)


def plain(extra):
    return {name: value.toPython() for name, value in extra.items()}


def test_extras_stay_nested_and_typed_in_files(spark, tmp_path):
    value = '{"device_id": "a", "fw": {"v": [1, 2.5, {"x": null}], "ok": true}, "n": 3, "s": "3"}'
    df = spark.createDataFrame([("iot-telemetry", "k", v) for v in (value, f"[{value}]")], "topic string, key string, value string")
    route_messages(df, F.lit(DAY)).telemetry.write.partitionBy("date", "device_id").parquet(str(tmp_path / "t"))
    for row in spark.read.parquet(str(tmp_path / "t")).collect():
        extra = plain(row.extra)
        assert extra == {"fw": {"v": [1, 2.5, {"x": None}], "ok": True}, "n": 3, "s": "3"}
        assert isinstance(extra["n"], int) and isinstance(extra["s"], str)


def test_rejected_records_of_a_list_keep_their_own_text(spark):
    values = ['[{"device_id": "a"}, {"n": {"x": 1}}, 5]', '{"device_id": "b"', '{"a": 1, "a": 2}', "true", '{"n":   1}']
    df = spark.createDataFrame([("iot-telemetry", "k", v) for v in values], "topic string, key string, value string")
    assert rows(route_messages(df, F.lit(DAY)).rejects, "value", "reason") == {
        ('{"n":{"x":1}}', "missing_device_id"): 1,
        ("5", "bad_json"): 1,
        ('{"device_id": "b"', "bad_json"): 1,
        ('{"a": 1, "a": 2}', "bad_json"): 1,
        ("true", "bad_json"): 1,
        ('{"n":   1}', "missing_device_id"): 1,
    }


def test_each_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("iot-telemetry", "k", "{}")], "topic string, key string, value string")
    plan = route_messages(df, F.lit(DAY)).telemetry._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") <= 2 and "from_json" not in plan


def test_routing(spark):
    t, e = "iot-telemetry", "iot-events"
    messages = [
        (t, '{"device_id": "a", "timestamp": "2024-01-01T00:00:00", "energy_usage": 1.5, "extra": 1}'),
        (t, '[{"device_id": "b", "signal_strength": 7}, {"device_id": "c"}, {"energy_usage": 2}]'),
        (e, '{"device_id": "a", "event_type": "failure", "component": "motor"}'),
        (t, '{"device_id": "x", "energy'),
        (t, "plain text"),
        (t, None),
        (e, '{"event_type": "failure"}'),
        (e, "[]"),
        (e, "5"),
        ("other", '{"device_id": "a"}'),
        ("other", "{"),
        (None, '{"device_id": "a"}'),
    ]
    df = spark.createDataFrame([(topic, "k", v) for topic, v in messages], "topic string, key string, value string")
    routed = route_messages(df, F.lit(DAY))
    assert rows(routed.telemetry, "device_id", "energy_usage", "signal_strength", "date") == {
        ("a", 1.5, None, DAY): 1,
        ("b", None, 7, DAY): 1,
        ("c", None, None, DAY): 1,
    }
    assert rows(routed.events, "device_id", "event_type", "component") == {("a", "failure", "motor"): 1}
    assert rows(routed.rejects, "topic", "reason") == {
        (t, "bad_json"): 3,
        (t, "missing_device_id"): 1,
        (e, "missing_device_id"): 2,
        (e, "bad_json"): 1,
        ("other", "unknown_topic"): 1,
        ("other", "bad_json"): 1,
        (None, "unknown_topic"): 1,
    }


def test_nothing_is_lost_or_silently_changed(spark):
    t, e = "iot-telemetry", "iot-events"
    messages = [
        (t, '{"device_id": "a", "signal_strength": 45.5}'),
        (t, '{"device_id": "b", "signal_strength": "x", "temperature": "hot"}'),
        (t, '{"device_id": "c", "signal_strength": 99999999999}'),
        (t, '{"device_id": "", "signal_strength": 1}'),
        (t, '{"device_id": " ", "signal_strength": 1}'),
        (t, '{"device_id": "d", "timestamp": "soon"}'),
        (t, '{"device_id": "e", "signal_strength": 12.0, "energy_usage": "1.5", "firmware": {"v": 2}, "tags": [1]}'),
        (e, '{"device_id": "f", "duration_min": "12"}'),
        (e, '{"device_id": "g", "duration_min": 12.0, "event_timestamp": "2024-01-01T00:00:00", "note": null}'),
        (e, '[{"device_id": "h"}, 5, "x", null, {"device_id": 7}]'),
    ]
    df = spark.createDataFrame([(topic, "k", v) for topic, v in messages], "topic string, key string, value string")
    routed = route_messages(df, F.lit(DAY))
    kept = {r.device_id: r for r in routed.telemetry.collect()}
    assert kept.keys() == {"e"} and kept["e"].signal_strength == 12 and kept["e"].energy_usage == 1.5
    assert plain(kept["e"].extra) == {"firmware": {"v": 2}, "tags": [1]}
    events = {r.device_id: (r.duration_min, plain(r.extra)) for r in routed.events.collect()}
    assert events == {"f": (12, {}), "g": (12, {"note": None}), "h": (None, {}), "7": (None, {})}
    assert rows(routed.rejects, "reason") == {
        ("bad_value: signal_strength",): 2,
        ("bad_value: temperature, signal_strength",): 1,
        ("missing_device_id",): 2,
        ("bad_value: timestamp",): 1,
        ("bad_json",): 3,
    }
