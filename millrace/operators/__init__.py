"""DataFrame to DataFrame building blocks."""

from millrace.operators.anomalies import anomaly_rules, confirm_arrivals, confirm_batch, describe, last_arrivals
from millrace.operators.joins import HotLimits, left_join
from millrace.operators.keyed import latest_per_key
from millrace.operators.layout import spread
from millrace.operators.previous import previous_time
from millrace.operators.quality import (
    AuditError,
    NoNulls,
    expect_no_nulls,
    expect_unique_rows,
    null_audit,
    require_rows,
)

__all__ = [
    "AuditError",
    "HotLimits",
    "NoNulls",
    "anomaly_rules",
    "confirm_arrivals",
    "confirm_batch",
    "describe",
    "expect_no_nulls",
    "expect_unique_rows",
    "last_arrivals",
    "latest_per_key",
    "left_join",
    "null_audit",
    "previous_time",
    "require_rows",
    "spread",
]
