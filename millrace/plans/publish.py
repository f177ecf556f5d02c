"""Write, audit, publish: rows reach a table only after its audits pass.

New rows are written to a staging table beside the target, the audits look at the
staged rows (with those already in the target, when appending), and only then
does the target change. Nulls are counted by the staging write itself. A failed audit leaves the target as it was and keeps
the staging table for inspection.

What is about to be released is written down first, in a note of its own in the
namespace's folder, and struck out at the end. The note is a lease: it names
its owner and when it expires. If a run is broken off in between, ``recover``
(which every later publish into the namespace calls) finishes it, as all audits
had passed by then; but it lets a run alone that another driver may still be
executing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession

from millrace.operators.quality import Audit, AuditError, NoNulls, failed_checks, null_audit
from millrace.session import create_text, move_files, put_text, read_texts, remove_path
from millrace.sources.tables import append_table, create_namespace, layer_name, replace_table

DEFAULT_AUDITS: tuple[Audit, ...] = (null_audit,)


def new_run_id() -> str:
    """Suffix for staging tables; random, as two runs may start in one second."""
    return uuid.uuid4().hex[:12]


def staging_name(table: str, run_id: str) -> str:
    return f"{table}__stg_{run_id}"


def _additive(audits: Sequence[Audit]) -> list[Audit]:
    """The audits, those of nulls in the form that the staging write can count."""
    return [NoNulls() if audit is null_audit else audit for audit in audits]


def _stage(
    df: DataFrame, table: str, run_id: str, fmt: str, partition_by: Sequence[str], audits: Sequence[Audit] = ()
) -> tuple[DataFrame, dict[str, int]]:
    """Write the staging table; returns it and the nulls that the write has counted, by column.

    The counts come from the tasks that write: each of them counts once, however
    often it had to be tried.
    """
    staging, counted, seen = staging_name(table, run_id), {}, Observation()
    for audit in _additive(audits):
        if isinstance(audit, NoNulls):
            counted |= audit.counts(df.select(*[c for c in df.columns if c not in partition_by], *partition_by))
    if counted:
        df = df.observe(seen, *[count.alias(name) for name, count in counted.items()])
    replace_table(df, staging, fmt, partition_by)
    return df.sparkSession.table(staging), dict(seen.get) if counted else {}


def _nulls(rows: DataFrame | None, names: Sequence[str]) -> dict[str, int]:
    return {r.subject: r.failures for r in null_audit(rows, names).collect()} if rows is not None and names else {}


def _check(
    staged: DataFrame, nulls: dict[str, int], table: str, run_id: str, mode: str, audits: Sequence[Audit], scope: str
) -> None:
    """Raise unless all audits pass. Nulls of the staged rows are known; only the target is searched for more."""
    spark, rows, target = staged.sparkSession, staged, None
    if mode == "append" and scope == "table" and spark.catalog.tableExists(table):
        target = spark.table(table)
        rows = target.unionByName(staged)
    failures, others = [], []
    for audit in _additive(audits):
        if not isinstance(audit, NoNulls):
            others.append(audit)
            continue
        names = list(audit.counts(rows))
        # The first column may be another one in the target.
        here, there = _nulls(staged, [n for n in names if n not in nulls]) | nulls, _nulls(target, names)
        found = [("no_nulls", name, here[name] + there.get(name, 0)) for name in names]
        failures += [f for f in found if f[2]]
    failures += failed_checks(rows, others)
    if failures:
        raise AuditError(table, staging_name(table, run_id), failures)


#: Seconds after which a release whose driver has not finished it may be taken over by another one.
LEASE = 6 * 3600
#: This driver, and the releases that it is executing just now.
_OWNER, _RUNNING = uuid.uuid4().hex, set()


def _namespace_of(table: str) -> str:
    return table.rpartition(".")[0] or "default"


def _notes(spark: SparkSession, namespace: str) -> str:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {namespace}").filter("info_name = 'Location'").collect()
    return f"{rows[0].info_value.rstrip('/')}/_releases"


def _journal(spark: SparkSession, namespace: str) -> dict[str, dict]:
    """Releases under way in a namespace: run id -> steps ([table, mode, format, partition columns]), owner, expiry."""
    return {name: json.loads(text) for name, text in read_texts(spark, _notes(spark, namespace)).items() if text and name[0] != "."}


def _lease(steps: list) -> str:
    return json.dumps({"steps": steps, "owner": _OWNER, "expires": time.time() + LEASE})


def _take_over(spark: SparkSession, namespace: str, run_id: str, note: dict) -> bool:
    """Make a release that was broken off our own; not one that may still be running, or that another driver takes."""
    if run_id in _RUNNING or note["owner"] != _OWNER and note["expires"] > time.time():
        return False
    claim = f"{_notes(spark, namespace)}/.{run_id}-{note['owner']}-{int(note['expires'])}"
    if note["owner"] != _OWNER and not create_text(spark, claim, _OWNER):
        return False
    put_text(spark, f"{_notes(spark, namespace)}/{run_id}", _lease(note["steps"]))
    remove_path(spark, claim)
    return True


def recover(spark: SparkSession, namespace: str) -> list[str]:
    """Finish releases that were broken off; returns the tables that had been left.

    Those of this driver count as broken off when it is not executing them, those of others when their
    lease has expired.
    """
    finished = []
    for run_id, note in _journal(spark, namespace).items():
        if _take_over(spark, namespace, run_id, note):
            finished += _finish(spark, namespace, run_id, note["steps"])
    return finished


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _as_in(spark: SparkSession, staging: str, table: str, run_id: str) -> str:
    """A table with the staged rows whose files can be files of ``table``: the staging table or a copy of it.

    The copy has the columns, types and partitions of the target, and takes the place of the staging table.
    """
    fitted = f"{table}__fit_{run_id}"
    if spark.catalog.tableExists(staging):
        fields = [{(f.name, f.dataType) for f in spark.table(t).schema} for t in (staging, table)]
        if fields[0] == fields[1] and _partitions(spark, staging) == _partitions(spark, table):
            return staging
        columns = [spark.table(staging)[f.name].cast(f.dataType).alias(f.name) for f in spark.table(table).schema]
        replace_table(spark.table(staging).select(*columns), fitted, "parquet", _partitions(spark, table))
        spark.sql(f"DROP TABLE {staging}")
    return fitted


def _move_rows(spark: SparkSession, source: str, table: str) -> None:
    """Make the files of one table files of another one; a repeat moves those that are left."""
    move_files(spark, _location(spark, source), _location(spark, table))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Partition Provider'").collect()
    if described and described[0].data_type == "Catalog" and _partitions(spark, table):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {source}")


def _release(spark: SparkSession, table: str, run_id: str, mode: str, fmt: str, partition_by: Sequence[str]) -> bool:
    """Make the staged rows visible in the target and remove the staging table.

    Replacing a table, or publishing it for the first time, renames the staging
    table, and an append to a Parquet table moves its files, so neither writes
    rows of equal columns again, and a file is in the target once, however often
    the move is taken up. Partitioned tables are written when they are replaced:
    catalogs differ in whether a rename takes the partitions along. Every step
    leaves what the next one needs, so the release can be taken up again; it
    does nothing, and says so, when it was finished before.
    """
    staging, old, done = staging_name(table, run_id), f"{table}__old_{run_id}", f"{table}__done_{run_id}"
    exists = spark.catalog.tableExists(table)
    if spark.catalog.tableExists(done):  # all rows are in the target
        spark.sql(f"DROP TABLE {done}")
        return True
    if not spark.catalog.tableExists(staging) and not spark.catalog.tableExists(f"{table}__fit_{run_id}"):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        return False
    if exists and mode == "append" and fmt == "parquet" and table.count(".") < 2:
        _move_rows(spark, _as_in(spark, staging, table, run_id), table)
        return True
    if partition_by or (exists and mode == "append"):
        rows = spark.table(staging)
        if exists and mode == "append":
            append_table(rows.select(*spark.table(table).columns), table, fmt, partition_by)
        else:
            replace_table(rows, table, fmt, partition_by)
        spark.sql(f"ALTER TABLE {staging} RENAME TO {done}")
        spark.sql(f"DROP TABLE {done}")
        return True
    if exists:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return True


def _finish(spark: SparkSession, namespace: str, run_id: str, steps: list) -> list[str]:
    """Release all tables of a run, then strike out its note; returns those that were not released before."""
    _RUNNING.add(run_id)
    try:
        released = [table for table, mode, fmt, keys in steps if _release(spark, table, run_id, mode, fmt, keys)]
    finally:
        _RUNNING.discard(run_id)
    remove_path(spark, f"{_notes(spark, namespace)}/{run_id}")
    return released


def _release_all(spark: SparkSession, namespace: str, run_id: str, steps: list) -> None:
    if not create_text(spark, f"{_notes(spark, namespace)}/{run_id}", _lease(steps)):
        raise RuntimeError(f"run {run_id} is being released already")
    _finish(spark, namespace, run_id, steps)


def publish(
    df: DataFrame,
    table: str,
    mode: str = "append",
    audits: Sequence[Audit] = DEFAULT_AUDITS,
    scope: str = "table",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    run_id: str | None = None,
) -> DataFrame:
    """Stage ``df``, audit it and publish it as ``table``; returns the table.

    ``mode`` is "append" or "overwrite". With ``scope="table"`` the audits see
    the whole table as it would become, with ``scope="batch"`` only the new
    rows. Raises ``AuditError`` when an audit fails. Rows are appended to Parquet
    tables exactly once, whatever breaks off. An append in another format is one
    job of its writer; if it is broken off after its commit and before the note
    is struck out, ``recover`` appends the rows again.
    """
    if mode not in ("append", "overwrite") or scope not in ("table", "batch"):
        raise ValueError(f"unknown mode {mode!r} or scope {scope!r}")
    run_id, namespace = run_id or new_run_id(), _namespace_of(table)
    recover(df.sparkSession, namespace)
    staged, nulls = _stage(df, table, run_id, fmt, partition_by, audits)
    _check(staged, nulls, table, run_id, mode, audits, scope)
    _release_all(df.sparkSession, namespace, run_id, [[table, mode, fmt, list(partition_by)]])
    return df.sparkSession.table(table)


def publish_layer(
    tables: Mapping[str, DataFrame],
    namespace: str,
    layer: str | None = None,
    mode: str = "append",
    audits: Sequence[Audit] = DEFAULT_AUDITS,
) -> dict[str, DataFrame]:
    """Publish every table of a layer on its own, in the given order."""
    return {
        name: publish(df, layer_name(namespace, name, layer), mode, audits) for name, df in tables.items()
    }


@dataclass(frozen=True)
class Model:
    """A table as a function of named tables: inputs or other models of the run."""

    build: Callable[..., DataFrame]
    inputs: Sequence[str]
    mode: str = "overwrite"
    audits: Sequence[Audit] = field(default=())


def publish_dag(
    spark: SparkSession,
    models: Mapping[str, Model],
    inputs: Mapping[str, DataFrame],
    namespace: str,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Stage all models, audit all, then publish all.

    A model that reads another one of the run reads its staged table, so every
    table is computed once. If any model or audit fails, no target changes and
    the staging tables stay. The publishing itself is one step per table; if it
    is broken off, the next publish into the namespace, or ``recover``, ends it.
    """
    run_id = run_id or new_run_id()
    create_namespace(spark, namespace)
    recover(spark, namespace)
    order = TopologicalSorter({n: [i for i in m.inputs if i in models] for n, m in models.items()})
    names = list(order.static_order())
    known, nulls = dict(inputs), {}
    for name in names:
        model = models[name]
        built = model.build(*[known[i] for i in model.inputs])
        known[name], nulls[name] = _stage(built, layer_name(namespace, name), run_id, "parquet", (), model.audits)
    for name in names:
        model = models[name]
        _check(known[name], nulls[name], layer_name(namespace, name), run_id, model.mode, model.audits, "table")
    steps = [[layer_name(namespace, name), models[name].mode, "parquet", []] for name in names]
    _release_all(spark, namespace, run_id, steps)
    return {name: spark.table(layer_name(namespace, name)) for name in names}
