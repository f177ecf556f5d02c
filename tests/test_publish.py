import re
from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace.operators import AuditError, NoNulls, expect_unique_rows, null_audit
from millrace.plans import publish as module
from millrace.plans.publish import Model, publish, publish_dag, publish_layer, recover, staging_name
from tests.helpers import rows


def names(spark, namespace):
    return {t.name for t in spark.catalog.listTables(namespace)}


def frame(spark, *values):
    return spark.createDataFrame([(v, v) for v in values], "id int, v int")


def test_append_then_append_again(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 1, 2), table)
    out = publish(frame(spark, 1, 2), table)
    assert rows(out) == {(1, 1): 2, (2, 2): 2}
    assert names(spark, namespace) == {"facts"}


def test_failure_leaves_target_and_keeps_staging(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 1), table)
    with pytest.raises(AuditError) as error:
        publish(frame(spark, 2, None), table, run_id="r1")
    assert error.value.staging == staging_name(table, "r1")
    assert error.value.failures == [("no_nulls", "id", 1)]
    assert rows(spark.table(table)) == {(1, 1): 1}
    assert spark.table(error.value.staging).count() == 2


def test_failure_before_the_table_exists(spark, namespace):
    with pytest.raises(AuditError):
        publish(frame(spark, None), f"{namespace}.facts", run_id="r1")
    assert names(spark, namespace) == {"facts__stg_r1"}


def test_audits_see_old_and_new_rows_unless_limited(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 1), table)
    with pytest.raises(AuditError, match="unique_rows"):
        publish(frame(spark, 1), table, audits=[expect_unique_rows])
    publish(frame(spark, 1), table, audits=[expect_unique_rows], scope="batch")
    assert spark.table(table).count() == 2


def test_nulls_are_counted_by_the_staging_write(spark, namespace, monkeypatch):
    table, searched = f"{namespace}.facts", []

    def search(df, columns):
        searched.append((df.count(), list(columns)))
        return null_audit(df, columns)

    monkeypatch.setattr(module, "null_audit", search)
    publish(frame(spark, 1, 2), table, audits=[NoNulls("all")])
    assert searched == []
    publish(frame(spark, 3), table, audits=[NoNulls("all")])
    assert searched == [(2, ["id", "v"])]  # the target alone
    with pytest.raises(AuditError) as error:
        publish(frame(spark, None, 4, None), table, audits=[NoNulls("all")], scope="batch")
    assert error.value.failures == [("no_nulls", "id", 2), ("no_nulls", "v", 2)] and len(searched) == 1
    publish(frame(spark, None), table, audits=[])
    with pytest.raises(AuditError) as error:  # those of the target and of the batch together
        publish(frame(spark, None, 5), table, audits=[NoNulls(["v"]), expect_unique_rows])
    assert error.value.failures == [("no_nulls", "v", 2), ("unique_rows", "id, v", 1)]
    publish(spark.range(0).selectExpr("id", "id AS v"), table, mode="overwrite", audits=[NoNulls("all")])
    assert spark.table(table).count() == 0


def test_overwrite_swaps_the_table(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 1, None), table, audits=[])
    out = publish(frame(spark, 3), table, mode="overwrite", audits=[null_audit])
    assert rows(out) == {(3, 3): 1}
    assert names(spark, namespace) == {"facts"}
    with pytest.raises(AuditError):
        publish(frame(spark, None), table, mode="overwrite")
    assert rows(spark.table(table)) == {(3, 3): 1}
    with pytest.raises(ValueError):
        publish(frame(spark, 1), table, mode="upsert")


def test_columns_are_matched_by_name_and_partitions_kept(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 1), table, partition_by=["v"])
    out = publish(frame(spark, 5).selectExpr("v + 1 AS v", "id"), table, partition_by=["v"])
    assert rows(out, "id", "v") == {(1, 1): 1, (5, 6): 1}
    out = publish(frame(spark, 8), table, mode="overwrite", partition_by=["v"])
    assert rows(out, "id", "v") == {(8, 8): 1}
    assert names(spark, namespace) == {"facts"}


def test_layer(spark, namespace):
    out = publish_layer({"a": frame(spark, 1), "b": frame(spark, 2)}, namespace, "bronze")
    assert set(out) == {"a", "b"} and names(spark, namespace) == {"a_bronze", "b_bronze"}


def models(audits=()):
    return {
        "total": Model(lambda doubled, raw: doubled.unionAll(raw), ("doubled", "raw")),
        "doubled": Model(lambda raw: raw.selectExpr("id * 2 AS id", "v"), ("raw",), audits=audits),
    }


def test_dag_runs_in_order_and_replaces(spark, namespace):
    for value in (1, 5):
        out = publish_dag(spark, models([null_audit]), {"raw": frame(spark, value)}, namespace)
    assert rows(out["total"], "id") == {(10,): 1, (5,): 1}
    assert names(spark, namespace) == {"total", "doubled"}


def test_dag_failure_changes_no_table(spark, namespace):
    publish_dag(spark, models(), {"raw": frame(spark, 1)}, namespace)
    with pytest.raises(AuditError):
        publish_dag(spark, models([null_audit]), {"raw": frame(spark, 7, None)}, namespace, run_id="r2")
    assert rows(spark.table(f"{namespace}.total"), "id") == {(2,): 1, (1,): 1}
    assert {"total__stg_r2", "doubled__stg_r2"} < names(spark, namespace)


def test_dag_model_error_changes_no_table(spark, namespace):
    broken = models() | {"bad": Model(lambda total: total.select("missing"), ("total",))}
    with pytest.raises(Exception, match="missing"):
        publish_dag(spark, broken, {"raw": frame(spark, 1)}, namespace, run_id="r3")
    assert not {"total", "doubled", "bad"} & names(spark, namespace)


@pytest.mark.parametrize("before", ["RENAME TO {ns}.total__old", "RENAME TO {ns}.total$", "DROP TABLE IF EXISTS {ns}.total__old"])
def test_a_release_broken_off_is_finished_by_the_next_run(spark, namespace, monkeypatch, before):
    publish_dag(spark, models(), {"raw": frame(spark, 1)}, namespace)
    usual, pattern = type(spark).sql, re.compile(before.format(ns=namespace).replace(".", r"\."))

    def breaks(self, text, *args, **kwargs):
        if pattern.search(text):
            raise RuntimeError("lost")
        return usual(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        publish_dag(spark, models(), {"raw": frame(spark, 5)}, namespace, run_id="r7")
    monkeypatch.setattr(type(spark), "sql", usual)
    recover(spark, namespace)
    assert rows(spark.table(f"{namespace}.total"), "id") == {(10,): 1, (5,): 1}
    assert rows(spark.table(f"{namespace}.doubled"), "id") == {(10,): 1}
    assert names(spark, namespace) == {"total", "doubled"}
    assert recover(spark, namespace) == [] and module._journal(spark, namespace) == {}
    publish_dag(spark, models(), {"raw": frame(spark, 2)}, namespace)
    assert rows(spark.table(f"{namespace}.doubled"), "id") == {(4,): 1}


@pytest.mark.parametrize("keys", [[], ["v"]])
@pytest.mark.parametrize("change", ["id", "cast(id AS int) AS id"])
def test_an_append_broken_off_after_its_files_are_there_adds_no_row(spark, namespace, monkeypatch, keys, change):
    table = f"{namespace}.facts"
    publish(frame(spark, 1, 2), table, partition_by=keys)
    usual = type(spark).sql

    def breaks(self, text, *args, **kwargs):
        if "DROP TABLE" in text and ("__stg_r9" in text or "__fit_r9" in text):
            raise RuntimeError("lost")
        return usual(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", breaks)
    for _ in range(2):  # the second one breaks off in recover
        with pytest.raises(RuntimeError, match="lost"):
            publish(frame(spark, 3).selectExpr(change, "v"), table, partition_by=keys, run_id="r9")
    monkeypatch.setattr(type(spark), "sql", usual)
    recover(spark, namespace)
    assert rows(spark.table(table), "id", "v") == {(k, k): 1 for k in (1, 2, 3)}
    assert spark.table(table).schema["id"].dataType == frame(spark, 1).schema["id"].dataType
    assert names(spark, namespace) == {"facts"} and recover(spark, namespace) == []


def test_a_run_of_another_driver_is_left_alone_until_its_lease_expires(spark, namespace, monkeypatch):
    table, usual = f"{namespace}.facts", module.move_files
    publish(frame(spark, 1), table)

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "move_files", lost)
    monkeypatch.setattr(module, "_OWNER", "another driver")
    with pytest.raises(RuntimeError, match="lost"):
        publish(frame(spark, 2), table, run_id="r1")
    monkeypatch.undo()
    assert recover(spark, namespace) == [] and rows(spark.table(table), "id") == {(1,): 1}
    publish(frame(spark, 3), table)
    assert rows(spark.table(table), "id") == {(1,): 1, (3,): 1}
    monkeypatch.setattr(module.time, "time", lambda: 4e9)
    assert recover(spark, namespace) == [table] and recover(spark, namespace) == []
    assert rows(spark.table(table), "id") == {(1,): 1, (2,): 1, (3,): 1}
    assert usual is module.move_files and names(spark, namespace) == {"facts"}


def test_two_publishers_at_once(spark, namespace):
    table = f"{namespace}.facts"
    publish(frame(spark, 0), table)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: publish(frame(spark, k), table), range(1, 9)))
    assert rows(spark.table(table), "id") == {(k,): 1 for k in range(9)}
    assert names(spark, namespace) == {"facts"} and module._journal(spark, namespace) == {}


def test_an_append_moves_files_and_can_be_broken_off(spark, namespace, monkeypatch):
    table = f"{namespace}.facts"
    publish(frame(spark, 1, 2), table)
    usual = module.move_files

    def half(session, source, target):
        usual(session, source, target)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "move_files", half)
    with pytest.raises(RuntimeError, match="lost"):
        publish(frame(spark, 3), table)
    monkeypatch.setattr(module, "move_files", usual)
    publish(frame(spark, 4).selectExpr("v", "id"), table)
    assert rows(spark.table(table), "id", "v") == {(k, k): 1 for k in (1, 2, 3, 4)}
    assert names(spark, namespace) == {"facts"}
    out = publish(frame(spark, 5).selectExpr("cast(id AS bigint) AS id", "v"), table)  # other types: written
    assert rows(out, "id") == {(k,): 1 for k in range(1, 6)}
