"""Guarded parsing of text columns: a malformed value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankscope import vocabulary as v


def safe_int(name: str) -> Column:
    """The integer in a text column, NULL for anything but an optional sign and digits.

    ``try_cast`` also turns digits beyond the integer range into NULL under ANSI mode.
    """
    text = F.col(name).cast("string")
    return F.when(text.rlike(v.INTEGER_TEXT), text.try_cast("int"))


def safe_date(name: str) -> Column:
    """The date in a text column, NULL unless it is a real day written ``yyyy-MM-dd``."""
    text = F.col(name).cast("string")
    return F.when(text.rlike(v.DATE_TEXT), text.try_cast("date"))


def malformed(raw: str, parsed: str) -> Column:
    """True where a value was present in the file and could not be parsed."""
    return F.col(raw).isNotNull() & F.col(parsed).isNull()


def text_or_default(name: str, default: str) -> Column:
    """The text as it is, spaces included; ``default`` where it is NULL or only spaces."""
    text = F.col(name)
    return F.when(F.trim(text) == "", F.lit(default)).otherwise(F.coalesce(text, F.lit(default)))
