"""Chart-shaped tables derived from the order and event tables.

Each table ranks all entities per market and period by a whole-number score (ties to the smaller
key) and adds the history of an entity in its market. Ranks are found through bins of the score, so
a market-day of any size is no hotspot; in the history, a group has at most one row per period. Each chart
is written at its first use in an application and read back by every later query on the same files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.operators.joins import one_per_key
from rankscope.operators.ordering import dealt, rank_by_score
from rankscope.sources.readers import with_release_lag
from rankscope.sources.stored import stored_once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _once(
    spark: SparkSession, sf_dir: str, name: str, tables: Sequence[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """A derived chart, written at its first use as the history leaves it and read by all later ones."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]
    return stored_once(spark, name, paths, build)


def ranked(scores: DataFrame, rows: int | None = None) -> DataFrame:
    """``(fecha, pais, key, score)`` rows, ``rows`` at most, with their rank per date and market."""
    return rank_by_score(scores, ["fecha", "pais"], "score", "key", "rank", rows).drop("score")


def with_history(
    chart: DataFrame, previous_period: Column, periods: str, streak: str, rows: int | None = None
) -> DataFrame:
    """History of each entity in its market, in period order.

    ``previous_period`` is the date one period before ``fecha``. All columns share one window order,
    so there is one shuffle and one sort; columns that a query does not use are pruned. ``rows``, an upper
    bound of the rows if known, bounds the rows that a task sorts.
    """
    order = Window.partitionBy("pais", "key").orderBy("fecha")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_date, last_rank = F.lag("fecha").over(order), F.lag("rank").over(order)
    rank = F.col("rank")
    dated = dealt(chart, ["pais", "key"], rows).withColumns(
        {
            periods: F.row_number().over(order),
            "peak_rank": F.min("rank").over(so_far),
            "last_date": last_date,
            "last_rank": last_rank,
            "entry_rank": F.first("rank").over(so_far),
            "entry_date": F.first("fecha").over(so_far),
        }
    )
    adjacent = F.col("last_date") == previous_period
    status = (
        F.when(F.col("last_date").isNull(), v.NEW_ENTRY)
        .when(~adjacent, v.RE_ENTRY)
        .when(rank < F.col("last_rank"), v.MOVED_UP)
        .when(rank > F.col("last_rank"), v.MOVED_DOWN)
        .otherwise(v.NO_CHANGE)
    )
    run_start = F.when(~F.coalesce(adjacent, F.lit(False)), F.col(periods))
    return (
        dated.withColumn("entry_status", status)
        .withColumn("previous_rank", F.when(adjacent, F.col("last_rank")))
        .withColumn("run_start", run_start)
        .withColumn(streak, F.col(periods) - F.max("run_start").over(so_far) + 1)
        .drop("last_date", "last_rank", "run_start")
    )


def _daily_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("ts").cast("date").alias("fecha"),
            F.col("event_type").alias("pais"),
            F.col("user_id").alias("key"),
        )
        .agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("score"))
    )


def _artist() -> dict[str, Column]:
    return {
        "artist_uri": F.format_string("artist:%d", "key"),
        "artist_name": F.format_string("Artist %d", "key"),
    }


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        rows = table(spark, sf_dir, "events").count()
        scores = ranked(_daily_scores(spark, sf_dir), rows)
        return with_history(scores, F.date_sub("fecha", 1), "days_on_chart", "consecutive_days", rows)

    return _once(spark, sf_dir, "daily", ["events"], build).withColumns(_artist())


def daily_best(spark: SparkSession, sf_dir: str, ranks: int) -> DataFrame:
    """The best ``ranks`` of each day and market, without history.

    For questions about the first places only: each task cuts to them before the shuffle.
    """
    order = Window.partitionBy("fecha", "pais").orderBy(F.desc("score"), "key")
    placed = _daily_scores(spark, sf_dir).withColumn("rank", F.row_number().over(order))
    return placed.filter(F.col("rank") <= ranks).withColumns(_artist()).drop("key", "score")


def daily_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users ranked per event type and day, in the columns of the daily artist chart."""
    return _daily(spark, sf_dir).select(
        *["fecha", "pais", "rank", "artist_uri", "artist_name", "peak_rank", "previous_rank"],
        *["days_on_chart", "consecutive_days", "entry_status", "entry_rank", "entry_date"],
    )


def daily_chart_with_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily chart plus a copy of one market in which every row is new every day."""
    chart = daily_chart(spark, sf_dir)
    stuck = chart.filter(F.col("pais") == "click").withColumns(
        {
            "pais": F.lit(v.EXCLUDED_MARKET),
            "entry_status": F.lit(v.NEW_ENTRY),
            "days_on_chart": F.lit(1),
        }
    )
    return chart.unionByName(stuck)


def _spoiled(name: str, key_mod: int, values: dict[int, str | None]) -> Column:
    """The column as text, replaced where the key has one of the given remainders."""
    text = F.col(name).cast("string")
    for remainder, value in values.items():
        text = F.when(F.col("key") % key_mod == remainder, F.lit(value)).otherwise(text)
    return text.alias(name)


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily chart as its raw file would hold it: all text, some of it malformed."""
    chart = _daily(spark, sf_dir).withColumnsRenamed(
        {"fecha": "date", "pais": "country", "artist_uri": "uri"}
    )
    spoiled = {
        "date": _spoiled("date", 13, {1: "2023-02-30", 2: "2023"}),
        "rank": _spoiled("rank", 11, {1: "x", 2: "99999999999", 3: " 12"}),
        "days_on_chart": _spoiled("days_on_chart", 17, {1: "", 2: "7.0"}),
    }
    return chart.select(
        *[spoiled.get(c, F.col(c).cast("string").alias(c)) for c in v.ARTISTS_DAILY_COLUMNS]
    )


def _shipped(spark: SparkSession, sf_dir: str, unit: str, market: str) -> DataFrame:
    """Quantity shipped per period, market of the supplier, and part.

    ``market`` is ``nation`` or ``region``. The suppliers are broadcast if counting finds few enough, so that no
    line is shuffled for its market; the optimizer does not see how small they are behind their join.
    """
    places = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("pais"), "n_regionkey"
    )
    if market == "region":
        regions = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
        )
        places = places.join(regions, "n_regionkey").withColumn("pais", F.col("region"))
    suppliers = (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(F.broadcast(places.select("s_nationkey", "pais")), "s_nationkey")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(one_per_key(suppliers), "l_suppkey")
        .groupBy(
            F.date_trunc(unit, "l_shipdate").cast("date").alias("fecha"),
            "pais",
            F.col("l_partkey").alias("key"),
        )
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("score"))
    )


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts ranked per supplier region and week, with the history that the weekly album chart shows."""

    def build() -> DataFrame:
        rows = table(spark, sf_dir, "lineitem").count()
        scores = ranked(_shipped(spark, sf_dir, "week", "region"), rows)
        chart = with_history(scores, F.date_sub("fecha", 7), "weeks_on_chart", "consecutive_weeks", rows)
        return chart.drop("peak_rank", "previous_rank")

    return _once(spark, sf_dir, "weekly", ["lineitem", "supplier", "nation", "region"], build)


def _albums(weekly: DataFrame) -> DataFrame:
    """The names of parts as albums: added behind the joins, which carry the number alone."""
    return weekly.withColumns(
        {
            "album_uri": F.format_string("album:%d", "key"),
            "album_name": F.format_string("Album %d", "key"),
            "artist_names": F.format_string("Artist %d", F.col("key") % 100),
        }
    )


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``label``: the brand of the part."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("label"))


def _released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``release_date``: the first date on which the part was ordered."""

    def build() -> DataFrame:
        return (
            table(spark, sf_dir, "lineitem")
            .select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("key"))
            .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
            .groupBy("key")
            .agg(F.min("o_orderdate").cast("date").alias("release_date"))
        )

    return _once(spark, sf_dir, "released", ["lineitem", "orders"], build)


def weekly_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _albums(_weekly(spark, sf_dir))


def weekly_with_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _albums(_weekly(spark, sf_dir).join(one_per_key(_brands(spark, sf_dir)), "key", "left"))


def weekly_with_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _weekly(spark, sf_dir).join(one_per_key(_released(spark, sf_dir)), "key", "left")
    return with_release_lag(_albums(dated))


def _weekly_with_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and release date of a part in one table, so that the chart is joined and shuffled once."""

    def build() -> DataFrame:
        return _brands(spark, sf_dir).join(_released(spark, sf_dir), "key", "full")

    attributes = _once(spark, sf_dir, "attributes", ["part", "lineitem", "orders"], build)
    return with_release_lag(_albums(_weekly(spark, sf_dir).join(one_per_key(attributes), "key", "left")))


def weekly_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly ranks with both attributes, in the columns of the weekly album chart."""
    return _weekly_with_both(spark, sf_dir).drop("key")


def _raw_albums(weekly: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of a weekly chart as its raw file would hold them: all text, some of it malformed."""
    chart = weekly.withColumnsRenamed({"fecha": "date", "pais": "country", "album_uri": "uri"})
    spoiled = {
        "rank": _spoiled("rank", 11, {1: "x"}),
        "label": _spoiled("label", 7, {1: "  ", 2: None}),
        "entry_rank": _spoiled("entry_rank", 11, {4: "n/a", 5: None}),
        "release_date": _spoiled("release_date", 13, {1: "2023-02-30", 2: "2023", 3: None}),
    }
    return chart.select(*[spoiled.get(c, F.col(c).cast("string").alias(c)) for c in columns])


def weekly_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_albums(_weekly_with_both(spark, sf_dir), v.ALBUMS_WEEKLY_COLUMNS)


def weekly_raw_with_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw weekly chart for questions about labels: orders are not read for a release date."""
    undated = weekly_with_brand(spark, sf_dir).withColumn("release_date", F.lit(None).cast("date"))
    return _raw_albums(undated, v.ALBUMS_WEEKLY_COLUMNS)


def monthly_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts ranked per supplier nation and month, in the columns of the cohort study."""

    def build() -> DataFrame:
        rows = table(spark, sf_dir, "lineitem").count()
        scores = ranked(_shipped(spark, sf_dir, "month", "nation"), rows)
        chart = with_history(scores, F.add_months("fecha", -1), "days_on_chart", "consecutive_days", rows)
        return chart.select("fecha", "pais", "key", "rank", "days_on_chart")

    return _once(spark, sf_dir, "monthly", ["lineitem", "supplier", "nation"], build).select(
        F.col("fecha").alias("date"),
        F.col("pais").alias("country"),
        "rank",
        F.format_string("artist:%d", "key").alias("artist_uri"),
        F.format_string("Artist %d", "key").alias("artist_name"),
        "days_on_chart",
    )


def predictions(spark: SparkSession, sf_dir: str, cut: int = 1000) -> DataFrame:
    """A fixed classifier: documents longer than ``cut`` characters are called good."""
    size = F.col("n_chars")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "n_chars")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            (F.col("doc_id") % 5).cast("int").alias("fold_id"),
            F.col("quality").cast("double").alias("label"),
            size.cast("double").alias("score"),
            F.when(size > cut, 1.0).otherwise(0.0).alias("prediction"),
        )
    )
