"""Movement in the top of the chart, permanence by band, and market diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.aggregates import median, share_when
from rankscope.functions.banding import band_order, rank_band


def top_status(
    chart: DataFrame,
    date: str = "fecha",
    rank: str = "rank",
    status: str = "entry_status",
    depth: int = 10,
) -> DataFrame:
    """Per date, how the rows of the top ``depth`` got there."""
    s = F.col(status)
    return (
        chart.filter(F.col(rank) <= depth)
        .groupBy(date)
        .agg(
            share_when(s == v.NEW_ENTRY).alias("share_new_entry"),
            share_when(s == v.RE_ENTRY).alias("share_re_entry"),
            share_when(s == v.NO_CHANGE).alias("share_no_change"),
            share_when(s.isin(v.MOVED_UP, v.MOVED_DOWN)).alias("share_movement"),
        )
        .orderBy(date)
    )


def turnover_facts(daily: DataFrame, date: str = "fecha") -> DataFrame:
    """One row: mean intake, mean unchanged share, and the first date with the largest intake."""
    intake = F.col("share_new_entry") + F.col("share_re_entry")
    return daily.withColumn("share_ingresos", intake).agg(
        F.avg("share_ingresos").alias("promedio_ingresos"),
        F.avg("share_no_change").alias("promedio_no_change"),
        F.min_by(date, F.struct(-F.col("share_ingresos"), date)).alias("pico_fecha"),
        F.max("share_ingresos").alias("pico_share_ingresos"),
    )


def band_permanence(
    chart: DataFrame,
    rank: str = "rank",
    days: str = "days_on_chart",
    streak: str = "consecutive_days",
    status: str = "entry_status",
    accuracy: int | None = None,
) -> DataFrame:
    """Median time on the chart and share of new entries by rank band, bands in order."""
    return (
        chart.filter(F.col(rank).isNotNull() & F.col(days).isNotNull())
        .withColumn("banda_rank", rank_band(rank))
        .groupBy("banda_rank")
        .agg(
            median(days, accuracy).alias("mediana_dias_en_chart"),
            median(streak, accuracy).alias("mediana_dias_consecutivos"),
            share_when(F.col(status) == v.NEW_ENTRY).alias("share_new_entry"),
        )
        .orderBy(band_order("banda_rank", v.RANK_BANDS))
    )


def market_diagnostics(
    chart: DataFrame,
    market: str = "pais",
    date: str = "fecha",
    rank: str = "rank",
    status: str = "entry_status",
    days: str = "days_on_chart",
    depth: int = 10,
    min_rows: int = 1000,
    accuracy: int | None = None,
) -> DataFrame:
    """Per market with at least ``min_rows`` rows in the top: coverage, turnover, median age."""
    return (
        chart.filter(F.col(rank) <= depth)
        .groupBy(market)
        .agg(
            F.count("*").alias("observaciones_top10"),
            F.count_distinct(date).alias("dias_cubiertos"),
            share_when(F.col(status) == v.NEW_ENTRY).alias("share_new_entry_top10"),
            share_when(F.col(status) == v.NO_CHANGE).alias("share_no_change_top10"),
            median(days, accuracy).alias("mediana_days_on_chart"),
        )
        .filter(F.col("observaciones_top10") >= min_rows)
    )


def _never_settles() -> Column:
    return (F.col("share_no_change_top10") == 0) & (F.col("mediana_days_on_chart") <= 1)


def anomalous_markets(
    diagnostics: DataFrame, market: str = "pais", new_entry_from: float = 0.90
) -> DataFrame:
    """Markets whose top is nearly all new entries, or never unchanged and at most a day old."""
    mostly_new = F.col("share_new_entry_top10") >= new_entry_from
    return diagnostics.filter(mostly_new | _never_settles()).orderBy(market)


def volatile_markets(
    diagnostics: DataFrame,
    market: str = "pais",
    new_entry_from: float = 0.90,
    limit: int | None = None,
) -> DataFrame:
    """The other markets, most new entries first; ``limit`` 15 gives the published list.

    A market with an unknown median and no unchanged row is in neither table: both tests are
    unknown for it.
    """
    settled = (F.col("share_new_entry_top10") < new_entry_from) & ~_never_settles()
    ranked = diagnostics.filter(settled).orderBy(F.desc("share_new_entry_top10"), market)
    return ranked if limit is None else ranked.limit(limit)


def stable_markets(volatility: DataFrame, market: str = "pais", limit: int = 10) -> DataFrame:
    """The ``limit`` markets with the largest unchanged share."""
    return volatility.orderBy(F.desc("share_no_change_top10"), market).limit(limit)
