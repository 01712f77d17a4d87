"""Who holds the first place: concentration, reach and diversity of leaders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAYS = "dias_pais_en_no1"
MARKETS = "paises_con_no1"


def leaders(
    chart: DataFrame,
    entity: str = "artist_name",
    market: str = "pais",
    rank: str = "rank",
    at: int = 1,
) -> DataFrame:
    """Rows at rank ``at`` per entity and the markets led, most rows first.

    Entities are grouped by name, so two keys with one name count as one; give the key column as
    ``entity`` to keep them apart.
    """
    return (
        chart.filter(F.col(rank) == at)
        .groupBy(entity)
        .agg(F.count("*").alias(DAYS), F.count_distinct(market).alias(MARKETS))
        .orderBy(F.desc(DAYS), entity)
    )


def leader_share(table: DataFrame, entity: str = "artist_name", k: int = 10) -> DataFrame:
    """One row: share of the first ``k`` leaders in all leader rows, and the first leader.

    The top ``k`` and the total are stacked and summed, which needs neither a window over all
    entities nor a join.
    """
    top = table.orderBy(F.desc(DAYS), entity).limit(k)
    first = F.min_by(F.struct(entity, DAYS, MARKETS), F.struct(-F.col(DAYS), entity))
    parts = top.agg(F.sum(DAYS).alias("top"), first.alias("first")).unionByName(
        table.agg(F.sum(DAYS).alias("total")), allowMissingColumns=True
    )
    return parts.agg(
        F.try_divide(F.sum("top"), F.sum("total")).alias("share_top10"),
        F.sum("total").alias("total_no1"),
        F.any_value("first", True).alias("first"),
    ).select(
        "share_top10",
        "total_no1",
        F.col(f"first.{entity}").alias(entity),
        F.col(f"first.{DAYS}").alias(DAYS),
        F.col(f"first.{MARKETS}").alias(MARKETS),
    )


def leader_reach(
    table: DataFrame,
    entity: str = "artist_name",
    min_days: int = 150,
    local_until: int = 3,
    global_from: int = 20,
    per_segment: int = 5,
    highlighted: int = 12,
) -> DataFrame:
    """The strongest leaders with at least ``min_days``: overall, local ones and global ones.

    Segments overlap: a highlighted leader is listed again as local or global if it is one.
    """
    strong = table.filter(F.col(DAYS) >= min_days)
    by_days = [F.desc(DAYS), F.asc(entity)]
    by_days_and_markets = [F.desc(DAYS), F.desc(MARKETS), F.asc(entity)]
    segments = {
        "highlighted": strong.orderBy(*by_days_and_markets).limit(highlighted),
        "local": strong.filter(F.col(MARKETS) <= local_until).orderBy(*by_days).limit(per_segment),
        "global": strong.filter(F.col(MARKETS) >= global_from)
        .orderBy(*by_days)
        .limit(per_segment),
    }
    named = [df.withColumn("segment", F.lit(name)) for name, df in segments.items()]
    return reduce(DataFrame.unionByName, named)


def leader_diversity(
    chart: DataFrame,
    entity: str = "artist_name",
    date: str = "fecha",
    rank: str = "rank",
    rows: int = 30,
) -> DataFrame:
    """Distinct leaders per date and their mean over the last ``rows`` dates that have a leader.

    The window has no partition key: by then there is one row per date.
    """
    recent = Window.orderBy(date).rowsBetween(1 - rows, 0)
    return (
        chart.filter(F.col(rank) == 1)
        .groupBy(date)
        .agg(F.count_distinct(entity).alias("artistas_distintos_en_no1"))
        .withColumn("promedio_30d", F.avg("artistas_distintos_en_no1").over(recent))
        .orderBy(date)
    )


def leader_diversity_facts(diversity: DataFrame) -> DataFrame:
    """One row: fewest, most and mean distinct leaders of a date."""
    n = "artistas_distintos_en_no1"
    return diversity.agg(
        F.min(n).alias("minimo"), F.max(n).alias("maximo"), F.avg(n).alias("promedio")
    )
