"""Column expressions built only from Spark's own functions."""

from millrace.functions.numbers import number_text, round_scaled
from millrace.functions.times import epoch_seconds, whole_days_between

__all__ = ["epoch_seconds", "number_text", "round_scaled", "whole_days_between"]
