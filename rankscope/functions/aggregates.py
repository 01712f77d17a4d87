"""Aggregate expressions that run inside one ``agg``, so that several share one pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_when(condition: Column) -> Column:
    """Share of rows where the condition holds; unknown counts as not holding."""
    return F.avg(F.when(condition, 1).otherwise(0))


def median(name: str, accuracy: int | None = None) -> Column:
    """The lower median of a whole-number column.

    Exact by default: period counts on a chart have few distinct values, and the exact value does
    not depend on how the rows are partitioned. For columns with very many distinct values give
    ``accuracy`` (1000 in the published tables) to use the bounded sketch instead.
    """
    if accuracy is not None:
        return F.percentile_approx(name, 0.5, accuracy)
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}`)").cast("int")


def null_count(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def distinct_rows(name: str) -> Column:
    """Distinct values with NULL as a value of its own, as counting distinct rows gives."""
    has_null = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
    return F.count_distinct(F.col(name)) + has_null


def guarded_percent(part: Column, whole: Column, scale: int) -> Column:
    """Percent rounded half up, NULL when there are no rows."""
    return F.when(whole > 0, F.round(part / whole * 100, scale))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
