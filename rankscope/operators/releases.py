"""Labels, release timing and debut strength on the item chart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.aggregates import median, share_when
from rankscope.functions.banding import band_order, lag_bucket, rank_band
from rankscope.functions.parsing import text_or_default


def label_top(
    chart: DataFrame,
    label: str = "label",
    item: str = "album_uri",
    rank: str = "rank",
    depth: int = 10,
) -> DataFrame:
    """Rows and distinct items in the top ``depth`` per label, most rows first."""
    return (
        chart.filter(F.col(rank) <= depth)
        .withColumn("label_limpio", text_or_default(label, v.BLANK_LABEL))
        .groupBy("label_limpio")
        .agg(
            F.count("*").alias("semanas_en_top10"),
            F.count_distinct(item).alias("albumes_distintos"),
        )
        .orderBy(F.desc("semanas_en_top10"), "label_limpio")
    )


def label_first(chart: DataFrame, label: str = "label", rank: str = "rank") -> DataFrame:
    """Rows at rank 1 per label, most rows first."""
    return (
        chart.filter(F.col(rank) == 1)
        .withColumn("label_limpio", text_or_default(label, v.BLANK_LABEL))
        .groupBy("label_limpio")
        .agg(F.count("*").alias("semanas_en_no1"))
        .orderBy(F.desc("semanas_en_no1"), "label_limpio")
    )


def release_lag(
    chart: DataFrame, lag: str = "days_release_to_entry", longest: int = v.LONGEST_LAG
) -> DataFrame:
    """Rows per bucket of days from release to entry, with their share, buckets in order.

    The window has no partition key: it runs over the five bucket rows.
    """
    return (
        chart.filter(F.col(lag).between(0, longest))
        .withColumn("bucket_lag", lag_bucket(lag))
        .groupBy("bucket_lag")
        .count()
        .withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))
        .orderBy(band_order("bucket_lag", v.LAG_BUCKETS))
    )


def release_lag_facts(lags: DataFrame) -> DataFrame:
    """One row: share entering in the first week, in the first month, and after a year."""
    names = [name for _, name in v.LAG_BUCKETS]

    def share_in(buckets):
        return F.sum(F.when(F.col("bucket_lag").isin(buckets), F.col("share")))

    return lags.agg(
        share_in(names[:1]).alias("share_7"),
        share_in(names[:2]).alias("share_30"),
        share_in(names[-1:]).alias("share_catalogo"),
    )


def debut_permanence(
    chart: DataFrame,
    entry_rank: str = "entry_rank",
    weeks: str = "weeks_on_chart",
    rank: str = "rank",
    depth: int = 10,
    accuracy: int | None = None,
) -> DataFrame:
    """Median weeks on the chart and share of rows in the top, by band of the entry rank."""
    return (
        chart.filter(F.col(entry_rank).isNotNull() & F.col(weeks).isNotNull())
        .withColumn("banda_entry", rank_band(entry_rank))
        .groupBy("banda_entry")
        .agg(
            median(weeks, accuracy).alias("mediana_semanas_en_chart"),
            share_when(F.col(rank) <= depth).alias("share_tiempo_en_top10"),
        )
        .orderBy(band_order("banda_entry", v.RANK_BANDS))
    )


def debut_facts(debut: DataFrame) -> DataFrame:
    """One row: the entry band with the longest median stay and the one most often in the top.

    Equal values go to the better band.
    """
    order = band_order("banda_entry", v.RANK_BANDS)
    median_weeks, top_share = F.col("mediana_semanas_en_chart"), F.col("share_tiempo_en_top10")
    return debut.agg(
        F.min_by("banda_entry", F.struct(-median_weeks, order)).alias("banda_mas_longeva"),
        F.max(median_weeks).alias("mediana_semanas"),
        F.min_by("banda_entry", F.struct(-top_share, order)).alias("banda_mas_top10"),
        F.max(top_share).alias("share_tiempo_en_top10"),
    )
