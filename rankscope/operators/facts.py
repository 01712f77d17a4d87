"""The headline numbers of all insight tables in one long table, each with its sentence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.text import percent_text, thousands_text
from rankscope.operators.leadership import DAYS, MARKETS


def _topic(
    number: int, one_row: DataFrame, text: Column, values: dict[str, str], names: dict[str, str]
) -> DataFrame:
    """The facts of one topic, a row each. ``values`` and ``names`` map a fact to its column."""
    entries = [
        F.struct(
            F.lit(fact).alias("fact"),
            F.col(column).cast("double").alias("value"),
            F.lit(None).cast("string").alias("name"),
        )
        for fact, column in values.items()
    ] + [
        F.struct(
            F.lit(fact).alias("fact"),
            F.lit(None).cast("double").alias("value"),
            F.col(column).cast("string").alias("name"),
        )
        for fact, column in names.items()
    ]
    return one_row.select(
        F.lit(number).alias("topic"), text.alias("text"), F.inline(F.array(*entries))
    ).select("topic", "fact", "value", "name", "text")


def executive_facts(
    share: DataFrame,
    turnover: DataFrame,
    diversity: DataFrame,
    permanence: DataFrame,
    labels: DataFrame,
    lags: DataFrame,
    debut: DataFrame,
    entity: str = "artist_name",
) -> DataFrame:
    """Rows ``(topic, fact, value, name, text)`` from the insight tables.

    Takes the results of ``leader_share``, ``turnover_facts``, ``leader_diversity_facts``,
    ``band_permanence``, ``label_top``, ``release_lag_facts`` and ``debut_facts``. Every part is a
    one-row aggregate, stacked rather than joined. A topic without data has NULL text.
    """
    first_band, last_band = v.RANK_BANDS[0][1], v.RANK_BANDS[-1][1]
    bands = permanence.agg(
        *[
            F.max(F.when(F.col("banda_rank") == band, F.col("mediana_dias_en_chart"))).alias(name)
            for band, name in ((first_band, "first_band"), (last_band, "last_band"))
        ]
    )
    best_label = labels.orderBy(F.desc("semanas_en_top10"), "label_limpio").limit(1)
    col = F.col

    def sentence(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    topics = [
        _topic(
            1,
            share,
            sentence(
                "Ten entities hold ", percent_text(col("share_top10")),
                " of all first places; ", col(entity), " leads with ", thousands_text(col(DAYS)),
                " market-days in ", thousands_text(col(MARKETS)), " markets.",
            ),
            {"share_top10": "share_top10", "leader_days": DAYS, "leader_markets": MARKETS},
            {"leader": entity},
        ),
        _topic(
            2,
            turnover,
            sentence(
                "On an average date ", percent_text(col("promedio_ingresos"), 2),
                " of the top ten entered or came back and ",
                percent_text(col("promedio_no_change"), 2), " kept its place.",
            ),
            {"mean_intake": "promedio_ingresos", "mean_unchanged": "promedio_no_change"},
            {},
        ),
        _topic(
            3,
            diversity,
            sentence(
                "The first places of one date are held by ",
                F.format_string("%.1f", col("promedio")), " different entities on average, from ",
                thousands_text(col("minimo")), " to ", thousands_text(col("maximo")), ".",
            ),
            {"mean_leaders": "promedio", "min_leaders": "minimo", "max_leaders": "maximo"},
            {},
        ),
        _topic(
            4,
            bands,
            sentence(
                f"The median time on the chart is {first_band}: ",
                thousands_text(col("first_band")), f", {last_band}: ",
                F.coalesce(thousands_text(col("last_band")), F.lit("none")), ".",
            ),
            {"median_first_band": "first_band", "median_last_band": "last_band"},
            {},
        ),
        _topic(
            5,
            best_label,
            sentence(
                col("label_limpio"), " is the strongest label with ",
                thousands_text(col("semanas_en_top10")), " market-weeks in the top ten.",
            ),
            {"label_weeks": "semanas_en_top10"},
            {"label": "label_limpio"},
        ),
        _topic(
            6,
            lags,
            sentence(
                percent_text(col("share_7")), " of dated entries come in the first week, ",
                percent_text(col("share_30")), " in the first month and ",
                percent_text(col("share_catalogo")), " after more than a year.",
            ),
            {"share_week": "share_7", "share_month": "share_30", "share_late": "share_catalogo"},
            {},
        ),
        _topic(
            7,
            debut,
            sentence(
                "Entries at ", col("banda_mas_longeva"), " stay longest, a median of ",
                thousands_text(col("mediana_semanas")), " weeks; entries at ",
                col("banda_mas_top10"), " are most often in the top ten, ",
                percent_text(col("share_tiempo_en_top10"), 2), " of the time.",
            ),
            {"longest_weeks": "mediana_semanas", "best_top_share": "share_tiempo_en_top10"},
            {"longest_band": "banda_mas_longeva", "best_top_band": "banda_mas_top10"},
        ),
    ]
    return reduce(DataFrame.unionByName, topics).orderBy("topic", "fact")
