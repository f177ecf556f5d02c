import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace import streaming
from millrace.operators import anomaly_rules, confirm_batch, describe
from millrace.plans import serving
from millrace.plans.pipelines import load_iot, refresh_serving, run_iot_batch
from millrace.schemas import ANOMALIES_TOPIC, ENVELOPE, EVENTS_TOPIC, TELEMETRY, TELEMETRY_TOPIC
from millrace.sources import message_stream, scan_partitioned
from tests.helpers import HITS, confirmations, expected_confirmations, hits, rows
from tests.test_anomalies import random_messages

START = dt.datetime(2024, 1, 1)


def wait(*queries):
    for q in queries:
        q.awaitTermination()


def feed(spark, batches, folder, start):
    """Land each batch as files, then run the query started by ``start`` to its end."""
    for batch in batches:
        batch.write.mode("append").parquet(str(folder))
        wait(start())


def confirm(spark, batches, base, **options):
    def start():
        source = spark.readStream.schema(HITS).parquet(f"{base}/in")
        return streaming.start_confirmation(source, streaming.to_files(f"{base}/out"), f"{base}/state", **options)

    feed(spark, batches, f"{base}/in", start)
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/out")


@pytest.mark.parametrize("seed, parts", [(4, 1), (5, 4)])
def test_stream_equals_the_literal_model(spark, tmp_path, seed, parts):
    messages = random_messages(seed, 240)
    size = len(messages) // parts
    batches = [hits(spark, messages[i : i + size]) for i in range(0, len(messages), size)]
    assert confirmations(confirm(spark, batches, tmp_path)) == expected_confirmations(messages)


@pytest.mark.parametrize("parts, hot_rows", [(1, 10**6), (3, 10**6), (10, 10**6), (2, 10)])
def test_where_the_input_is_cut_makes_no_difference(spark, tmp_path, parts, hot_rows):
    """The order is that of arrival, also when times go back; hot devices are cut into ranges."""
    messages = random_messages(6, 200, ordered=False)
    size = 200 // parts
    batches = [hits(spark, messages[i : i + size]) for i in range(0, 200, size)]
    out = confirm(spark, batches, tmp_path, hot_rows=hot_rows)
    assert confirmations(out) == expected_confirmations(messages)


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    messages = random_messages(8, 60)
    batches = [hits(spark, messages[:30]), hits(spark, messages[30:])]
    confirm(spark, batches, tmp_path)
    (tmp_path / "state" / "commits" / "1").unlink()  # as if the second had failed at its end
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert confirmations(confirm(spark, [hits(spark, [])], tmp_path)) == expected_confirmations(messages)


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_history_is_a_log_of_changes(spark, tmp_path, parts):
    """Snapshots between make no difference, nor does a repeat of the micro-batch behind one."""
    messages = random_messages(11, 120)
    size = len(messages) // parts
    batches = [hits(spark, messages[i : i + size]) for i in range(0, len(messages), size)]
    out = confirm(spark, batches, tmp_path, snapshot_every=3)
    assert confirmations(out) == expected_confirmations(messages)
    stored = sorted(f.name for f in (tmp_path / "state" / "history").iterdir() if not f.name.startswith("."))
    assert stored == {1: ["0"], 3: ["0", "1-changed", "2-changed"], 10: ["6", "7-changed", "8-changed", "9"]}[parts]
    for folder in (tmp_path / "state" / "commits").iterdir():
        if folder.name in (str(parts - 1), f".{parts - 1}.crc"):
            folder.unlink()
    out = confirm(spark, [hits(spark, [])], tmp_path, snapshot_every=3)
    assert confirmations(out) == expected_confirmations(messages)


def test_a_micro_batch_stores_the_history_of_its_devices_only(spark, tmp_path):
    many = [(f"d{i}", START + dt.timedelta(seconds=i), i, [1, 2]) for i in range(200)]
    few = [("d7", START + dt.timedelta(minutes=9), 300, [1]), (None, START, 301, [2])]
    more = [("d8", START + dt.timedelta(minutes=9), 302, [1, 3])]
    out = confirm(spark, [hits(spark, m) for m in (many, few, more)], tmp_path)
    assert confirmations(out) == expected_confirmations(many + few + more)
    log = f"{tmp_path}/state/history"
    assert spark.read.parquet(f"{log}/0").count() == 400
    assert rows(spark.read.parquet(f"{log}/1-changed"), "device_id") == {("d7",): 3, (None,): 1}
    assert rows(spark.read.parquet(f"{log}/2-changed"), "device_id") == {("d8",): 4}
    size = {k: sum(f.stat().st_size for f in (tmp_path / "state/history" / k).glob("*.parquet")) for k in ("0", "2-changed")}
    assert size["2-changed"] * 2 < size["0"]


def test_a_time_that_cannot_be_read_stays_unconfirmed(spark, tmp_path):
    data = [(k, "d", "soon" if k % 2 else "2024-01-01T00:00:00", 9.0, 1.0, 1.0, 50) for k in range(8)]
    names = "message_id long, device_id string, timestamp string, energy_usage double, temperature double, vibration double, signal_strength int"
    rules = anomaly_rules(spark.createDataFrame(data, names), "message_id")
    expected = {(k, 1): k in (4, 6) for k in range(8)}
    assert confirmations(confirm_batch(rules)) == expected
    assert confirmations(confirm(spark, [rules], tmp_path)) == expected


def test_future_history_counts_and_twenty_bound(spark, tmp_path):
    later = [("d", START + dt.timedelta(hours=5), 1, [1]), ("d", START + dt.timedelta(hours=6), 2, [1])]
    early = [("d", START, 3, [1])]
    out = confirm(spark, [hits(spark, later), hits(spark, early)], tmp_path / "future")
    assert confirmations(out) == {(1, 1): False, (2, 1): False, (3, 1): True}

    first = [("d", START, 0, [1]), ("d", START, 1, [1])]
    between = [("d", START + dt.timedelta(seconds=i), 1 + i, [2]) for i in range(1, 20)]
    last = [("d", START + dt.timedelta(minutes=30), 50, [1])]
    out = confirm(spark, [hits(spark, m) for m in (first, between, last)], tmp_path / "bound")
    assert confirmations(out)[50, 1] is False


def test_ingest(spark, tmp_path):
    data = [
        (TELEMETRY_TOPIC, "k", '[{"device_id": "a", "energy_usage": 1.5}, {"device_id": "b"}]'),
        (EVENTS_TOPIC, "k", '{"device_id": "a", "event_type": "failure", "event_timestamp": "2024-01-01T00:00:00"}'),
        (TELEMETRY_TOPIC, "k", "{"),
        ("other", "k", '{"device_id": "a"}'),
    ]

    def run():
        def read(topics):
            return message_stream(spark, topics, fmt="parquet", path=str(tmp_path / "in"), maxFilesPerTrigger="1")

        day = F.lit(dt.date(2024, 1, 1))
        wait(*streaming.start_ingest(read, f"{tmp_path}/lake", f"{tmp_path}/state", ingest_date=day, other_topics=["other"]))

    spark.createDataFrame(data, ENVELOPE).write.parquet(str(tmp_path / "in"))
    run()
    run()  # nothing new: nothing doubles
    telemetry = scan_partitioned(spark, f"{tmp_path}/lake", "telemetry", TELEMETRY)
    assert rows(telemetry, "date", "device_id", "energy_usage") == {
        (dt.date(2024, 1, 1), "a", 1.5): 1,
        (dt.date(2024, 1, 1), "b", None): 1,
    }
    rejects = spark.read.parquet(f"{tmp_path}/lake/rejects")
    assert rows(rejects, "topic", "reason") == {(TELEMETRY_TOPIC, "bad_json"): 1, ("other", "unknown_topic"): 1}
    events, telemetry = load_iot(spark, f"{tmp_path}/lake")
    assert events.count() == 1 and telemetry.count() == 2


def test_closed_dates_are_compacted_once(spark, tmp_path):
    root, days = f"{tmp_path}/lake", [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    telemetry = "[" + ", ".join(f'{{"device_id": "{d}", "energy_usage": %d, "deep": {{"k": [%d]}}}}' for d in "ab") + "]"

    def land(day, numbers):
        for i in numbers:
            data = [(TELEMETRY_TOPIC, "k", telemetry % (i, i, i, i))]
            spark.createDataFrame(data, ENVELOPE).write.mode("append").parquet(f"{tmp_path}/in")

        def read(topics):
            return message_stream(spark, topics, fmt="parquet", path=f"{tmp_path}/in", maxFilesPerTrigger="1")

        wait(*streaming.start_ingest(read, root, f"{tmp_path}/state", ingest_date=F.lit(day), rejects=False))

    def compact(before):
        return streaming.compact_ingested(spark, root, "telemetry", before, TELEMETRY)

    def found(scan=streaming.scan_ingested):
        return scan(spark, root, "telemetry", TELEMETRY)

    def bag(df):
        return rows(df, "date", "device_id", "energy_usage")

    land(days[0], range(4))
    land(days[1], range(4, 6))
    before = bag(found())
    assert compact("2024-01-01") == [] and bag(found()) == before and sum(before.values()) == 12
    # A run that broke off left files without a note.
    stale = f"{root}/compacted/telemetry/date=2024-01-01/device_id=a"
    spark.createDataFrame([(77.0,)], "energy_usage double").write.parquet(stale)
    assert bag(found()) == before
    assert compact("2024-01-02") == [days[0]]
    assert bag(found()) == before == bag(found(scan_partitioned)) and compact("2024-01-02") == []
    assert streaming.ingest.finished_dates(spark, root, "telemetry") == {days[0]: 8}
    folder = tmp_path / "lake" / "telemetry" / "date=2024-01-01" / "device_id=a"
    assert len(list(folder.glob("*.parquet"))) == 4
    assert len(list((tmp_path / "lake" / "compacted" / "telemetry" / "date=2024-01-01" / "device_id=a").glob("*.parquet"))) == 1
    # Both places prune by date; an open date still takes rows.
    plan = found()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") == 2
    land(days[1], range(6, 7))
    assert bag(found()) == bag(found(scan_partitioned)) and found().count() == 14
    assert compact("2025-01-01") == [days[1]] and bag(found()) == bag(found(scan_partitioned))


def test_iot_batch_run_and_serving(spark, tmp_path, namespace):
    telemetry = [
        (f"2024-01-0{d}", dev, f"2024-01-0{d}T0{h}:00:00", 2.0 + h, 20.0 + h, 1.0, 50)
        for d in (1, 2) for dev in ("a", "b") for h in range(5)
    ]
    spark.createDataFrame(
        telemetry,
        "date string, device_id string, timestamp string, energy_usage double, temperature double, vibration double, signal_strength int",
    ).write.partitionBy("date", "device_id").parquet(f"{tmp_path}/telemetry")
    spark.createDataFrame(
        [("2024-01-01", "a", "2024-01-01T00:00:00", "failure", "motor")],
        "date string, device_id string, event_timestamp string, event_type string, component string",
    ).write.partitionBy("date", "device_id").parquet(f"{tmp_path}/events")
    for run in (1, 2):
        out = run_iot_batch(spark, str(tmp_path), namespace, "2024-01-02")
        assert {n: t.count() for n, t in out.items()} == {
            "gold_device_health": 4 * run,
            "gold_failure_prediction": 2 * run,
            "gold_maintenance_schedule": 4 * run,
        }
    keyed = describe(hits(spark, [("a", START, 1, [1]), ("b", START, 2, [2])]).withColumn("is_confirmed", F.lit(False)))
    served = refresh_serving(spark, keyed, namespace, namespace)
    assert served["anomaly_rollup"].count() == 2
    # The health table holds both runs, so the one anomaly of a day counts twice.
    assert rows(served["unified_device_health"], "pending_anomalies") == {(2,): 2, (0,): 2}


def anomaly_batch(spark, messages, confirmed=False):
    return describe(hits(spark, messages).withColumn("is_confirmed", F.lit(confirmed)))


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def test_upsert_keeps_the_latest_and_survives_a_replay(spark, tmp_path):
    first = anomaly_batch(spark, [("d", at(1), 1, [1, 2]), ("d", at(2, day=2), 2, [3])])
    second = anomaly_batch(spark, [("d", at(1), 0, [4])])
    schema, path = first.schema, f"{tmp_path}/keyed"

    def start():
        return streaming.start_upsert(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), path, f"{tmp_path}/state")

    feed(spark, [first, second], f"{tmp_path}/in", start)
    # The first micro-batch is delivered again, as after a failure.
    streaming.serving._write_version(first.withColumn("day", F.to_date("timestamp")), 0, path, ["timestamp"])
    expected = {("d", at(1), "low_signal"): 1, ("d", at(2, day=2), "high_vibration"): 1}
    keyed = streaming.read_keyed(spark, path, schema)
    assert rows(keyed, "device_id", "timestamp", "anomaly_type") == expected

    streaming.compact_days(spark, path, schema, before="2024-01-02")
    keyed = streaming.read_keyed(spark, path, schema)
    assert rows(keyed, "device_id", "timestamp", "anomaly_type") == expected
    assert spark.read.parquet(path).filter("day = '2024-01-01'").count() == 1


def test_rollup_stream_equals_the_batch_rollup(spark, tmp_path):
    rng = random.Random(3)
    messages = [
        (rng.choice("ab"), at(0, day=8) + dt.timedelta(minutes=7 * i), i, sorted(rng.sample([1, 2, 3, 4], rng.choice([1, 2]))))
        for i in range(60)
    ]
    batches = [anomaly_batch(spark, messages[:25]), anomaly_batch(spark, messages[25:], True)]
    # Days late, and a second message of a device and time that are there already.
    batches += [anomaly_batch(spark, [("a", at(3, day=1), 90, [2]), messages[0][:2] + (91, [3])])]

    def start():
        source = spark.readStream.schema(batches[0].schema).parquet(f"{tmp_path}/in")
        return streaming.start_upsert(
            source, f"{tmp_path}/keyed", f"{tmp_path}/state", rollup_path=f"{tmp_path}/hours", high_values=("HIGH",)
        )

    feed(spark, batches, f"{tmp_path}/in", start)
    keyed = serving.anomalies_latest(batches[0].unionAll(batches[1]).unionAll(batches[2]))
    expected = serving.anomaly_rollup(keyed, ("HIGH",))
    flat = [F.array_join(c, ",").alias(c) if c == "anomaly_types" else F.col(c) for c in expected.columns]
    for _ in range(2):
        got = streaming.read_rollup(spark, f"{tmp_path}/hours")
        assert rows(got.select(*flat)) == rows(expected.select(*flat))
        streaming.compact_rollup(spark, f"{tmp_path}/hours", before="2025-01-01")
    assert spark.read.parquet(f"{tmp_path}/hours").count() == expected.count()


def test_rollup_stream_keeps_rows_without_time(spark, tmp_path):
    batches = [
        anomaly_batch(spark, [("a", None, 1, [1]), ("a", at(1), 2, [1]), ("b", None, 3, [2])]),
        anomaly_batch(spark, [("a", None, 4, [3]), ("b", at(2), 5, [1])], True),
        anomaly_batch(spark, [(None, None, 6, [1]), (None, at(3), 7, [2])]),
    ]

    def start():
        source = spark.readStream.schema(batches[0].schema).parquet(f"{tmp_path}/in")
        return streaming.start_upsert(
            source, f"{tmp_path}/keyed", f"{tmp_path}/state", rollup_path=f"{tmp_path}/hours", high_values=("HIGH",)
        )

    feed(spark, batches, f"{tmp_path}/in", start)
    keyed = serving.anomalies_latest(batches[0].unionAll(batches[1]).unionAll(batches[2]))
    expected = serving.anomaly_rollup(keyed, ("HIGH",))
    flat = [F.array_join(c, ",").alias(c) if c == "anomaly_types" else F.col(c) for c in expected.columns]
    got = streaming.read_rollup(spark, f"{tmp_path}/hours")
    assert rows(got.select(*flat)) == rows(expected.select(*flat))
    assert got.filter("hour_bucket IS NULL").count() == 3


def test_rollup_of_repeats_and_late_rows(spark, tmp_path):
    """Repeated micro-batches change nothing, before and after the days were folded."""
    batches = [
        anomaly_batch(spark, [("a", at(1, k), k, [1]) for k in range(6)] + [("b", None, 20, [1])]),
        anomaly_batch(spark, [("a", at(1, 0), 30, [2]), ("a", at(1, 1), 31, [2]), ("b", None, 32, [3])], True),
        anomaly_batch(spark, [("a", at(1, 0), 40, [1]), ("c", at(5, day=3), 41, [4]), ("a", at(2), 42, [2])]),
    ]
    everything = batches[0].unionAll(batches[1]).unionAll(batches[2])
    expected = serving.anomaly_rollup(serving.anomalies_latest(everything), ("HIGH",))
    flat = [F.array_join(c, ",").alias(c) if c == "anomaly_types" else F.col(c) for c in expected.columns]

    def start():
        source = spark.readStream.schema(batches[0].schema).parquet(f"{tmp_path}/in")
        return streaming.start_upsert(
            source, f"{tmp_path}/keyed", f"{tmp_path}/state", rollup_path=f"{tmp_path}/hours", high_values=("HIGH",)
        )

    def repeat_last():
        for name in ("2", ".2.crc"):
            (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
        wait(start())

    def check():
        assert rows(streaming.read_rollup(spark, f"{tmp_path}/hours").select(*flat)) == rows(expected.select(*flat))

    feed(spark, batches, f"{tmp_path}/in", start)
    check()
    first = streaming.serving.rollup_changes(batches[0], None, ("HIGH",)).withColumn("day", F.to_date("hour_bucket"))
    streaming.serving._write_version(first, 0, f"{tmp_path}/hours", ["device_id"])  # the first one's changes once more
    check()
    repeat_last()
    check()
    streaming.compact_days(spark, f"{tmp_path}/keyed", batches[0].schema, before="2025-01-01")
    streaming.compact_rollup(spark, f"{tmp_path}/hours", before="2025-01-01")
    check()
    repeat_last()
    streaming.serving._write_version(first, 0, f"{tmp_path}/hours", ["device_id"])
    check()


def test_looking_up_replaced_rows_reads_no_whole_day(spark, tmp_path):
    stored = anomaly_batch(spark, [("d", at(h, m), h * 60 + m, [1]) for h in range(24) for m in range(60)])
    with_hour = stored.withColumn("day", F.to_date("timestamp")).withColumn("hour_number", streaming.serving.hour_number())
    streaming.serving._write_version(with_hour, 0, f"{tmp_path}/keyed", ["timestamp"])
    hour = (at(3) - dt.datetime(1970, 1, 1)) // dt.timedelta(hours=1)
    known = streaming.serving.stored_hours(spark, f"{tmp_path}/keyed", stored.schema, [hour])
    assert known.count() == 60
    fresh = anomaly_batch(spark, [("d", at(3, 5), 9, [2])])
    plan = streaming.serving.replaced_rows(known, fresh)._jdf.queryExecution().toString()
    assert f"PushedFilters: [IsNotNull(hour_number), EqualTo(hour_number,{hour})" in plan
    assert "PartitionFilters: [isnotnull(day" in plan
    # Other keys go before the versions are sorted.
    physical = plan[plan.index("== Physical Plan") :]
    assert physical.index("Window") < physical.index("LeftSemi")
    parts = streaming.serving.rollup_changes(fresh, streaming.serving.replaced_rows(known, fresh), ("HIGH",)).head().parts
    assert [(p.anomaly_type, p.n) for p in parts] == [("high_energy_usage", -1), ("high_temperature", 1)]


def test_refresh_of_single_days(spark, tmp_path):
    path = f"{tmp_path}/rollup"
    one = anomaly_batch(spark, [("d", at(1), 1, [1]), ("d", at(1, day=2), 2, [1])])
    streaming.refresh_rollup(one, path)
    two = anomaly_batch(spark, [("d", at(1), 1, [1]), ("d", at(1, 5), 3, [1]), ("d", at(1, 5, day=2), 4, [1])])
    streaming.refresh_rollup(two, path, days=["2024-01-01"])
    assert rows(spark.read.parquet(path), "hour_bucket", "total_anomalies") == {(at(1), 2): 1, (at(1, day=2), 1): 1}


def test_anomaly_messages_carry_json(spark):
    out = streaming.anomaly_messages(anomaly_batch(spark, [("d", at(1) + dt.timedelta(microseconds=5), 1, [1])])).head()
    assert (out.topic, out.key) == (ANOMALIES_TOPIC, "d")
    assert '"timestamp":"2024-01-01T01:00:00.000005"' in out.value
    assert '"anomaly_type":"high_energy_usage"' in out.value and '"is_confirmed":false' in out.value


def test_keyed_table_is_read_without_a_shuffle(spark, tmp_path):
    """One device has most rows; its hours lie in several buckets. Rows without device or time are keys as well."""
    path = f"{tmp_path}/it's keyed"
    messages = [("hot", at(h, m), h * 60 + m, [1]) for h in range(24) for m in range(0, 60, 5)]
    messages += [(d, at(h), 2000 + h, [2]) for d in ("b", None) for h in range(3)] + [("b", None, 3000, [3])]
    again = [("hot", at(h), 5000 + h, [3]) for h in range(24)] + [("b", None, 5100, [4]), ("hot", at(1, day=2), 5101, [1])]
    batches = [anomaly_batch(spark, messages), anomaly_batch(spark, again, True)]
    schema = batches[0].schema

    def start():
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        return streaming.start_upsert(source, path, f"{tmp_path}/state", buckets=5)

    feed(spark, batches, f"{tmp_path}/in", start)
    names = ["device_id", "timestamp", "anomaly_type", "is_confirmed"]
    expected = rows(serving.anomalies_latest(batches[0].unionAll(batches[1])), *names)
    keyed = streaming.read_keyed(spark, path, schema)
    assert rows(keyed, *names) == expected and sum(expected.values()) == len(messages) + 1
    physical = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in physical and "Bucketed: true" in physical and "Window" in physical
    hot = spark.read.parquet(path).where("device_id = 'hot'").select(F.input_file_name().alias("f"))
    assert hot.select(F.regexp_extract("f", r"_(\d{5})\.c", 1)).distinct().count() > 2
    one_day = keyed.where("day = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(day" in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == 1

    streaming.compact_days(spark, path, schema, before="2024-01-02")
    folded = streaming.read_keyed(spark, path, schema)
    assert rows(folded, *names) == expected
    assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(path).filter("day = '2024-01-01'").count() == 24 * 12 + 6


def test_keyed_table_begun_without_buckets_goes_on(spark, tmp_path):
    first, second = anomaly_batch(spark, [("d", at(1), 1, [1])]), anomaly_batch(spark, [("d", at(1), 2, [2]), ("d", at(2), 3, [1])])
    with_hour = first.withColumn("day", F.to_date("timestamp")).withColumn("hour_number", streaming.serving.hour_number())
    path = f"{tmp_path}/keyed"
    streaming.serving._write_version(with_hour, -1, path, ["timestamp"])

    def start():
        return streaming.start_upsert(spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in"), path, f"{tmp_path}/state")

    feed(spark, [second], f"{tmp_path}/in", start)
    assert streaming.serving.bucket_count(spark, path) is None
    expected = rows(serving.anomalies_latest(first.unionAll(second)), "timestamp", "anomaly_type")
    assert rows(streaming.read_keyed(spark, path, first.schema), "timestamp", "anomaly_type") == expected
