"""Rounding and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places as ``round(value * 10^d) / 10^d``.

    Spark's own two-argument ``round`` goes through the decimal text of the
    double and so gives another answer for values such as 1.005.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def number_text(value: Column) -> Column:
    """A double as plain text: ``10000000.0`` rather than Spark's ``1.0E7``.

    Exponents appear from 1e16 on, written ``1e+16``. Meant for the readings in
    messages, which are above 1; small numbers keep Spark's own form.
    """
    text = value.cast("string")
    plain = F.regexp_replace(value.cast("decimal(38,9)").cast("string"), r"(\.\d+?)0*$", "$1")
    exponent = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E", "e+")
    return (
        F.when(F.abs(value) < F.lit(1e7), text)
        .when(F.abs(value) < F.lit(1e16), plain)
        .otherwise(exponent)
    )
