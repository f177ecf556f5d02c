import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from millrace import sources
from millrace.operators import require_rows
from millrace.schemas import EVENTS, EVENTS_RAW, TELEMETRY
from millrace.sources import files
from tests.helpers import rows


@pytest.fixture()
def lake(spark, tmp_path):
    data = [
        ("2024-01-01", "0007", "2024-01-01T10:00:00", 1.0),
        ("2024-01-01", "d2", "2024-01-01T11:00:00", 2.0),
        ("2024-01-02", "d2", "2024-01-02T11:00:00", 3.0),
    ]
    df = spark.createDataFrame(data, "date string, device_id string, timestamp string, energy_usage double")
    df.write.partitionBy("date", "device_id").parquet(str(tmp_path / "telemetry"))
    return tmp_path


def test_partitioned_scan_keeps_keys_and_skips_corrupt_files(spark, lake):
    with open(lake / "telemetry" / "date=2024-01-01" / "device_id=d2" / "part-broken.parquet", "w") as f:
        f.write("this is no parquet file")
    df = sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY)
    assert rows(df, "date", "device_id", "energy_usage") == {
        (dt.date(2024, 1, 1), "0007", 1.0): 1,
        (dt.date(2024, 1, 1), "d2", 2.0): 1,
        (dt.date(2024, 1, 2), "d2", 3.0): 1,
    }
    assert [r.path.rsplit("/", 1)[1] for r in sources.damaged_files(spark, str(lake), "telemetry").collect()] == ["part-broken.parquet"]
    assert sources.scan_partitioned(spark, str(lake), "telemetry").count() == 3
    with pytest.raises(ValueError, match="part-broken"):
        sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY, damaged="fail")


def test_files_without_rows_are_sound(spark, lake):
    folder = str(lake / "telemetry" / "date=2024-01-01" / "device_id=d2")
    empty = spark.createDataFrame([], "timestamp string, energy_usage double").coalesce(1)
    for _ in range(3):
        empty.write.mode("append").parquet(folder)
    assert sources.damaged_files(spark, str(lake), "telemetry").count() == 0
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY, damaged="fail").count() == 3
    found = {r.n_rows for r in sources.checked_files(spark, str(lake), "telemetry", register=False).collect()}
    assert found == {0, 1}


def test_footers_are_read_once(spark, lake, monkeypatch):
    opened = []
    examined = files._examined

    def watched(spark, place, fresh, since):
        out = examined(spark, place, fresh, since)
        opened.append(sorted(r.path.rsplit("/", 1)[1] for r in out.collect()))
        return out

    monkeypatch.setattr(files, "_examined", watched)
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY).count() == 3
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY).count() == 3
    assert [len(o) for o in opened] == [3]  # nothing is opened the second time
    folder = lake / "telemetry" / "date=2024-01-02" / "device_id=d2"
    (folder / "later.parquet").write_text("no table")
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY).count() == 3
    assert [r.path.rsplit("/", 1)[1] for r in sources.damaged_files(spark, str(lake), "telemetry").collect()] == ["later.parquet"]
    assert opened[1:] == [["later.parquet"]]
    # A file that is mended has another length and time, and is looked at again.
    spark.createDataFrame([("2024-01-02T12:00:00", 4.0)], "timestamp string, energy_usage double").coalesce(1).write.parquet(str(lake / "new"))
    (part,) = (lake / "new").glob("*.parquet")
    (folder / "later.parquet").write_bytes(part.read_bytes())
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY).count() == 4
    assert opened[2:] == [["later.parquet"]] and not (lake / "telemetry" / "_footers").exists()


def test_many_damaged_files(spark, lake):
    folder = lake / "telemetry" / "date=2024-01-01" / "device_id=d2"
    for i in range(1005):
        (folder / f"bad{i}.parquet").write_text("no table")
    assert sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY).count() == 3


def test_damage_within_a_file_raises(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "'d' AS device_id", "date'2024-01-01' AS date").coalesce(1).write.partitionBy(
        "date", "device_id"
    ).parquet(str(tmp_path / "telemetry"))
    folder = tmp_path / "telemetry" / "date=2024-01-01" / "device_id=d"
    (file,) = folder.glob("*.parquet")
    content = bytearray(file.read_bytes())
    content[100:2000] = b"\xff" * 1900
    (folder / f".{file.name}.crc").unlink()
    file.write_bytes(content)
    assert sources.damaged_files(spark, str(tmp_path), "telemetry").count() == 0
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        sources.scan_partitioned(spark, str(tmp_path), "telemetry").selectExpr("sum(id)").collect()


def test_partition_prefix_and_pruning(spark, lake):
    day = sources.scan_partitioned(spark, str(lake), "telemetry/date=2024-01-01", TELEMETRY)
    assert {r.device_id for r in day.select("device_id", "date").collect()} == {"0007", "d2"}
    plan = (
        sources.scan_partitioned(spark, str(lake), "telemetry", TELEMETRY)
        .filter("date = '2024-01-02'")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(date" in plan


def test_enforce_schema(spark):
    df = spark.createDataFrame(
        [("d1", "2024-01-01T10:00:00.5", 7, "x")], "device_id string, event_timestamp string, duration_min int, extra string"
    )
    out = sources.enforce_schema(df, EVENTS, {"event_timestamp"})
    assert out.schema.fieldNames() == EVENTS_RAW.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in EVENTS]
    row = out.head()
    assert row.event_timestamp == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert row.duration_min == 7 and row.error_code is None and row.next_inspection_days is None


def test_enforce_schema_rejects_a_broken_time(spark):
    df = spark.createDataFrame([("d1", "soon")], "device_id string, event_timestamp string")
    with pytest.raises(Exception, match="soon"):
        sources.enforce_schema(df, EVENTS, {"event_timestamp"}).collect()


def test_require_rows(spark):
    df = spark.range(3)
    assert require_rows(df, "numbers") is df
    with pytest.raises(ValueError, match="numbers is empty"):
        require_rows(df.filter("id > 5"), "numbers")


def test_frame_from_columns(spark, at):
    df = sources.frame_from_columns(
        spark, {"s": ["a", None], "i": [1, 2], "f": [0.5, None], "t": [at(1), at(2)], "o": [None, None]}
    )
    assert [f.dataType for f in df.schema] == [
        T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType(), T.StringType()
    ]
    assert df.count() == 2
    declared = sources.frame_from_columns(spark, {"i": [1]}, T.StructType([T.StructField("i", T.LongType())]))
    assert declared.schema["i"].dataType == T.LongType()
    with pytest.raises(ValueError):
        sources.frame_from_columns(spark, {"a": [1], "b": []})


def test_csv_folder(spark, tmp_path):
    (tmp_path / "listings.csv").write_text("id,name\n1,flat\n2,house\n")
    (tmp_path / "hosts.csv").write_text("host,since\nx,2020\n")
    (tmp_path / "notes.txt").write_text("not a table")
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("since", T.StringType())])
    tables = sources.load_csv_folder(spark, str(tmp_path), {"hosts": schema})
    assert set(tables) == {"listings", "hosts"}
    assert tables["listings"].schema["id"].dataType == T.IntegerType()
    assert rows(tables["hosts"]) == {("x", "2020"): 1}


def test_paths_by_format(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_path(spark.range(3), path, "orc")
    sources.write_path(spark.range(2), path, "orc")
    assert sources.read_path(spark, path, "orc").count() == 2


def test_tables_by_layer(spark, namespace, tmp_path):
    df = spark.range(2)
    table = sources.layer_name(namespace, "orders", "bronze")
    sources.append_table(df, table)
    sources.append_table(df, table)
    assert sources.read_layer(spark, namespace, "orders", "bronze").count() == 4
    sources.replace_table(df, table)
    assert spark.table(table).count() == 2
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert sources.import_parquet(spark, str(tmp_path / "p"), table).count() == 5
    assert os.path.isdir(tmp_path / "p")


def test_model_input_scans_only_its_columns(spark, namespace):
    sources.replace_table(spark.range(2).selectExpr("id", "id AS other"), f"{namespace}.wide")
    df = sources.read_model(spark, f"{namespace}.wide", ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_create_namespace_twice(spark, namespace):
    sources.create_namespace(spark, namespace)
    assert spark.catalog.databaseExists(namespace)
