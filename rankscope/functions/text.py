"""Numbers as words for summary sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(value: Column, decimals: int = 1) -> Column:
    return F.format_string(f"%.{decimals}f%%", value * 100)


def thousands_text(value: Column) -> Column:
    """Whole number with thousands separators, decimals cut off."""
    return F.format_number(value.cast("long"), 0)
