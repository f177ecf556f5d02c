import datetime as dt
import random

import pytest

from millrace.operators import anomaly_rules, confirm_batch, describe
from millrace.plans import serving
from millrace.schemas import ANOMALIES
from tests.helpers import confirmations, expected_confirmations, hits, rows

START = dt.datetime(2024, 1, 1)
TELEMETRY = (
    "id bigint, device_id string, timestamp string, energy_usage double, temperature double, vibration double, signal_strength int"
)


def minutes(n):
    return START + dt.timedelta(minutes=n)


def test_rules_and_wording(spark):
    data = [
        (1, "d", "2024-01-01T00:00:00", 6.5, 32.5, 3.1, 29),
        (2, "d", "2024-01-01T00:00:01", 4.6, 28.5, 3.0, 30),
        (3, "d", "2024-01-01T00:00:02", None, None, None, None),
        (4, "d", "2024-01-01T00:00:03", 4.5, 28.0, None, None),
    ]
    rules = anomaly_rules(spark.createDataFrame(data, TELEMETRY), "id")
    out = describe(rules)
    nb = "\u202f"
    assert rows(out, "message_id", "entry", "entries", "anomaly_type", "severity", "description") == {
        (1, 1, 4, "high_energy_usage", "CRITICAL", f"Energy usage 6.5{nb}kWh (threshold:{nb}4.5)"): 1,
        (1, 2, 4, "high_temperature", "CRITICAL", f"Temperature 32.5{nb}°C (threshold:{nb}28)"): 1,
        (1, 3, 4, "high_vibration", "HIGH", f"Vibration 3.1{nb}m/s² (threshold:{nb}3.0)"): 1,
        (1, 4, 4, "low_signal", "MEDIUM", f"Signal strength 29% (threshold:{nb}30)"): 1,
        (2, 1, 2, "high_energy_usage", "HIGH", f"Energy usage 4.6{nb}kWh (threshold:{nb}4.5)"): 1,
        (2, 2, 2, "high_temperature", "HIGH", f"Temperature 28.5{nb}°C (threshold:{nb}28)"): 1,
    }
    assert rows(out, "is_confirmed", "confirmed_by") == {(False, None): 6}


def test_third_within_the_hour_is_confirmed(spark):
    messages = [("d", minutes(m), i, [1]) for i, m in enumerate((0, 30, 60, 121))]
    out = describe(confirm_batch(hits(spark, messages)))
    confirmed = out.filter("is_confirmed").collect()
    assert [r.message_id for r in confirmed] == [2]
    assert confirmed[0].description.endswith(" (Auto\u2011Confirmed)") and confirmed[0].confirmed_by == "system"


def test_history_reaches_twenty_entries_back(spark):
    # Two of type 1, then many of type 2, then the third of type 1, all in one hour.
    for between, confirmed in ((18, True), (19, False), (25, False)):
        messages = [("d", minutes(0), 0, [1]), ("d", minutes(1), 1, [1])]
        messages += [("d", minutes(2) + dt.timedelta(seconds=i), 2 + i, [2]) for i in range(between)]
        messages += [("d", minutes(50), 100, [1])]
        assert expected_confirmations(messages)[100, 1] is confirmed
        assert confirmations(confirm_batch(hits(spark, messages)))[100, 1] is confirmed


def test_bound_counts_from_the_start_of_the_message(spark):
    # 19 entries between; the message's own earlier anomalies do not push the first one out.
    messages = [("d", minutes(0), 0, [4]), ("d", minutes(1), 1, [4])]
    messages += [("d", minutes(2) + dt.timedelta(seconds=i), 2 + i, [2]) for i in range(18)]
    messages += [("d", minutes(50), 100, [1, 2, 3, 4])]
    assert expected_confirmations(messages)[100, 4] is True
    assert confirmations(confirm_batch(hits(spark, messages)))[100, 4] is True


def random_messages(seed, n, ordered=True):
    rng = random.Random(seed)
    times = [START + dt.timedelta(seconds=rng.randrange(0, n * 120)) for _ in range(n)]
    if ordered:
        times.sort()
    return [
        (rng.choice(["hot", "hot", "b"]), time, i, sorted(rng.sample([1, 2, 3, 4], rng.choice([1, 1, 2, 4]))))
        for i, time in enumerate(times)
    ]


@pytest.mark.parametrize("seed, slice_hours", [(1, 6), (2, 1), (3, 48)])
def test_batch_equals_the_literal_model(spark, seed, slice_hours):
    messages = random_messages(seed, 400)
    expected = expected_confirmations(messages)
    assert 0 < sum(expected.values()) < len(expected)
    out = confirm_batch(hits(spark, messages), slice_hours)
    assert out.count() == len(expected)
    assert confirmations(out) == expected


def test_keyed_table_keeps_the_last_of_a_message(spark):
    messages = [("d", minutes(0), 1, [1, 3]), ("d", minutes(5), 2, [2]), ("e", minutes(0), 3, [4])]
    narrow = confirm_batch(hits(spark, messages), keep_slice=True)
    with_slice = describe(serving.anomalies_latest(narrow))
    without = serving.anomalies_latest(describe(narrow.drop("time_slice")))
    assert rows(with_slice) == rows(without)
    assert rows(with_slice, "device_id", "anomaly_type") == {
        ("d", "high_vibration"): 1,
        ("d", "high_temperature"): 1,
        ("e", "low_signal"): 1,
    }


@pytest.fixture()
def anomalies(spark):
    data = [
        ("d", minutes(0), "b", "HIGH", "x", False, None),
        ("d", minutes(10), "a", "high", "x", True, "system"),
        ("d", minutes(20), "a", "high", "x", False, None),
        ("d", minutes(70), "a", "CRITICAL", "x", False, None),
    ]
    return spark.createDataFrame(data, ANOMALIES)


def test_rollup(anomalies):
    assert {r.hour_bucket: tuple(r)[2:] for r in serving.anomaly_rollup(anomalies).collect()} == {
        minutes(0): (3, 2, 2, ["a", "b"]),
        minutes(60): (1, 1, 0, ["a"]),
    }
    severe = serving.anomaly_rollup(anomalies, ("HIGH", "CRITICAL"))
    assert rows(severe, "high_severity_count") == {(1,): 2}


def test_unified_health(spark, anomalies):
    day, other = START.date(), dt.date(2024, 1, 2)
    schema = (
        "device_id string, date date, min_health_score double, days_since_maintenance int, "
        "vibration_anomalies bigint, temp_anomalies bigint"
    )
    health = spark.createDataFrame(
        [("d", day, 0.5, 100, 0, 0), ("d", other, 0.9, 1, 6, 0), ("e", day, 0.2, 1, 0, 0), ("f", day, 0.9, 999, 0, 0), ("g", day, 0.9, 1, 0, 3)],
        schema,
    )
    assert rows(serving.unified_device_health(health, anomalies)) == {
        ("d", day, 0.5, 100, 3, 1, 0.49, "P1"): 1,
        ("d", other, 0.9, 1, 0, 0, 0.06, "P2"): 1,
        ("e", day, 0.2, 1, 0, 0, 0.48, "P0"): 1,
        ("f", day, 0.9, 999, 0, 0, 0.16, "P0"): 1,
        ("g", day, 0.9, 1, 0, 0, 0.06, "P3"): 1,
    }
    twice = serving.unified_device_health(health.unionAll(health), anomalies)
    assert rows(twice.filter("device_id = 'd'"), "date", "pending_anomalies") == {(day, 6): 1, (other, 0): 1}
