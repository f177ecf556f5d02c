"""Audits: DataFrame in, a small report DataFrame out.

Every report has the columns ``check``, ``subject`` and ``failures``; an audit
passes when all its ``failures`` are zero. Reports have one row per audited
column or rule, so collecting one is safe at any table size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Audit = Callable[[DataFrame], DataFrame]


class AuditError(Exception):
    """A table did not pass its audits; the staged rows are kept under ``staging``."""

    def __init__(self, table: str, staging: str | None, failures: Sequence[tuple]):
        self.table, self.staging, self.failures = table, staging, list(failures)
        found = "; ".join(f"{check} on {subject}: {n}" for check, subject, n in self.failures)
        kept = f" (staged rows kept in {staging})" if staging else ""
        super().__init__(f"audit failed for {table}: {found}{kept}")


def _audited_names(df: DataFrame, columns: Sequence[str] | str | None) -> list[str]:
    if columns is None:
        return df.columns[:1]
    return df.columns if columns == "all" else list(columns)


def null_audit(df: DataFrame, columns: Sequence[str] | str | None = None) -> DataFrame:
    """Count nulls per column in one pass over the table.

    ``columns`` is a list of names, ``"all"``, or None for the first column
    only. The IS NULL filter is pushed to the Parquet reader, which skips row
    groups whose statistics show no null in any audited column.
    """
    names = _audited_names(df, columns)
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in names])
    counts = df.filter(any_null).agg(
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(
            F.lit("no_nulls").alias("check"),
            F.lit(c).alias("subject"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class NoNulls:
    """``null_audit`` of these columns, as an audit whose counts a write of the rows can gather on its way.

    The counts of two sets of rows add up to those of both.
    """

    columns: Sequence[str] | str | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        return null_audit(df, self.columns)

    def counts(self, df: DataFrame) -> dict[str, Column]:
        return {c: F.count_if(F.col(f"`{c}`").isNull()) for c in _audited_names(df, self.columns)}


def expect_no_nulls(df: DataFrame, column: str) -> DataFrame:
    """The column holds no null."""
    return null_audit(df, [column])


def expect_unique_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """No two rows agree in all of ``columns`` (default: every column).

    ``failures`` is the number of duplicated row groups. Two hashes per row are
    counted first; only rows whose hashes repeat are compared in full. Repeats
    are combined before the shuffle, so one row repeated very often is no hot spot.
    """
    names = list(columns) if columns is not None else df.columns
    picked = [F.col(f"`{c}`") for c in names]
    hashes = {"_a": F.xxhash64(*picked), "_b": F.xxhash64(F.lit(1), *picked)}
    hashed = df.select(*picked).withColumns(hashes)
    again = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    groups = hashed.join(again, ["_a", "_b"], "left_semi").groupBy(*picked).agg(F.count(F.lit(1)).alias("_copies"))
    groups = groups.filter("_copies > 1")
    return groups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique_rows").alias("check"), F.lit(", ".join(names)).alias("subject"), "failures"
    )


def failed_checks(df: DataFrame, audits: Sequence[Audit]) -> list[tuple]:
    """Run the audits and return (check, subject, failures) of those that fail."""
    if not audits:
        return []
    report = reduce(DataFrame.unionByName, [audit(df) for audit in audits])
    return [tuple(r) for r in report.filter("failures > 0").collect()]


def audited(df: DataFrame, label: str, audits: Sequence[Audit]) -> DataFrame:
    """Check only the incoming rows, before any write; raise or hand them on."""
    failures = failed_checks(df, audits)
    if failures:
        raise AuditError(label, None, failures)
    return df


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Raise if the input is empty; reads no more than one row to find out."""
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
    return df
