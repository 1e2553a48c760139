"""Averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def average(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def two_decimals(x: Column) -> Column:
    """Round the double's exact value, ties to even, as printing with ``.2f`` does."""
    return F.call_function("format_number", x, F.lit("0.00")).cast("double")
