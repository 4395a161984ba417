"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, 0 on a zero denominator."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def view_rate() -> Column:
    return ratio(F.col("deduped_impressions"), F.col("bid_requests")).alias("view_rate")


def counter(text: Column) -> Column:
    """A stored counter as a number; missing or non-numeric text is 0."""
    digits = F.when(text.rlike("^[+-]?[0-9]+$"), text)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0))
