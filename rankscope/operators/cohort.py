"""The cohort study's population: entity profiles, classes and strata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.banding import scope_class, stratum_key, tenure_class, tier_class
from rankscope.operators.joins import left_join_by_entity


def without_market(
    chart: DataFrame, excluded: str = v.EXCLUDED_MARKET, market: str = "country"
) -> DataFrame:
    """Rows of the other markets. Rows with a NULL market go too: the comparison is unknown."""
    return chart.filter(F.col(market) != excluded)


def since(chart: DataFrame, start: str = v.EVALUATION_START, date: str = "date") -> DataFrame:
    return chart.filter(F.col(date) >= F.lit(start).cast("date"))


def entity_profile(
    chart: DataFrame,
    entity: str = "artist_uri",
    market: str = "country",
    days: str = "days_on_chart",
    veteran_after: int = v.VETERAN_AFTER,
    global_after: int = v.GLOBAL_AFTER,
    rows: str | None = None,
) -> DataFrame:
    """Per entity: markets reached, longest time on a chart, and the classes that follow.

    Reads the whole history it is given. With ``rows`` it also counts the rows of the entity.
    """
    totals = [
        F.count_distinct(market).alias("country_count_by_artist"),
        F.max(days).alias("max_days_on_chart"),
    ]
    if rows:
        totals.append(F.count("*").alias(rows))
    return (
        chart.groupBy(entity)
        .agg(*totals)
        .withColumn("artist_tenure", tenure_class("max_days_on_chart", veteran_after))
        .withColumn("artist_scope", scope_class("country_count_by_artist", global_after))
    )


def population(
    chart: DataFrame,
    excluded: str = v.EXCLUDED_MARKET,
    start: str = v.EVALUATION_START,
    entity: str = "artist_uri",
    market: str = "country",
    date: str = "date",
    rank: str = "rank",
    days: str = "days_on_chart",
    veteran_after: int = v.VETERAN_AFTER,
    global_after: int = v.GLOBAL_AFTER,
    top_until: int = v.TOP_UNTIL,
    rows_per_task: int = 2_000_000,
) -> DataFrame:
    """Chart rows of the evaluation window with their profile, tier and stratum.

    Profiles see all dates, the rows only those from ``start`` on.
    """
    history = without_market(chart, excluded, market)
    profile = entity_profile(
        history, entity, market, days, veteran_after, global_after, rows="__rows"
    )
    joined = left_join_by_entity(
        since(history, start, date), profile, entity, "__rows", rows_per_task
    )
    return joined.withColumn("rank_tier", tier_class(rank, top_until)).withColumn(
        "partition_id", stratum_key("artist_tenure", "artist_scope", "rank_tier")
    )


def strata_from_counts(counts: DataFrame, target: int = v.SAMPLE_TARGET) -> DataFrame:
    """Allocation per stratum from ``(partition_id, count)`` rows.

    The window has no partition key: there is one row per stratum.
    """
    total = F.sum("count").over(Window.partitionBy())
    return (
        counts.withColumn("probability", F.col("count") / total)
        .withColumn("n_i", F.bround(F.col("probability") * target, 0).cast("int"))
        .withColumn("fraction", F.least(F.col("n_i") / F.col("count"), F.lit(1.0)))
    )


def strata(
    people: DataFrame, target: int = v.SAMPLE_TARGET, stratum: str = "partition_id"
) -> DataFrame:
    """Rows, share, proportional allocation (half to even) and fraction, largest first."""
    counts = people.groupBy(stratum).count()
    return strata_from_counts(counts, target).orderBy(F.desc("count"), stratum)
