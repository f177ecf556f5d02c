"""Split the packed name of a listing into its attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The separator and the mark before a rating.
SEPARATOR = "·"
STAR = "★"


def listings_parse(listings: DataFrame) -> DataFrame:
    """``description · ★rating · bedrooms · beds · baths``, where the rating may be absent.

    Parts that are missing become null. The packed column and two unused ones
    are dropped.
    """
    parts = F.split("name", SEPARATOR)

    def part(i: int):
        return F.trim(F.get(parts, F.lit(i)))

    rated = part(1).startswith(STAR)
    fields = {
        "description": part(0),
        "reviews": F.when(rated, F.trim(F.replace(part(1), F.lit(STAR), F.lit("")))),
    }
    for i, name in enumerate(["bedrooms", "beds", "baths"]):
        fields[name] = F.when(rated, part(i + 2)).otherwise(part(i + 1))
    return listings.withColumns(fields).drop("name", "neighbourhood_group", "license")
