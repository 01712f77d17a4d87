"""The registered queries: every named operator on the chart-shaped tables.

Each query takes ``(spark, sf_dir)``. Thresholds suit the derived charts; the library's defaults are
those of real chart data. ``presented`` gives whole numbers, fractions and dates one common form, so
that results of two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    ShortType,
)

from rankscope import vocabulary as v
from rankscope.functions.banding import all_strata
from rankscope.functions.parsing import safe_date, safe_int
from rankscope.operators import cohort, evaluation, facts, forest, leadership, profiling, releases
from rankscope.operators import quantiles, report, roc, sampling, segments, trees, turnover
from rankscope.plans import charts
from rankscope.plans.studies import (
    StudySettings,
    small,
    study_folds,
    study_population,
    study_sample,
)
from rankscope.session import kept
from rankscope.sources import readers, sinks
from rankscope.sources.stored import shared_folder, stored_once, tables_once

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = StudySettings(
    excluded="NATION_7",
    start="1996-01-01",
    veteran_after=4,
    global_after=16,
    top_until=8,
    target=5000,
)
REACH = {"min_days": 2, "local_until": 1, "global_from": 2}
MARKET_ROWS = 200
CLASSES = {0.0: "low", 1.0: "high"}
STRATA = tuple(all_strata())
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: presented(function(spark, sf_dir))
    return function


def presented(df: DataFrame) -> DataFrame:
    """Whole numbers as long, fractions rounded to six decimals, dates as ISO text."""

    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (IntegerType, ShortType)):
            c = c.cast("long")
        elif isinstance(field.dataType, (DoubleType, FloatType, DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


# Leaders of the daily chart.


@query
def leaders(spark, sf_dir):
    return leadership.leaders(charts.daily_best(spark, sf_dir, 1))


@query
def leader_share(spark, sf_dir):
    return leadership.leader_share(leaders(spark, sf_dir))


@query
def leader_reach(spark, sf_dir):
    return leadership.leader_reach(leaders(spark, sf_dir), **REACH)


@query
def leader_diversity(spark, sf_dir):
    return leadership.leader_diversity(charts.daily_chart(spark, sf_dir))


@query
def leader_diversity_facts(spark, sf_dir):
    return leadership.leader_diversity_facts(leader_diversity(spark, sf_dir))


# Turnover and markets.


@query
def top10_status(spark, sf_dir):
    return turnover.top_status(charts.daily_chart(spark, sf_dir))


@query
def turnover_facts(spark, sf_dir):
    return turnover.turnover_facts(top10_status(spark, sf_dir))


@query
def band_permanence(spark, sf_dir):
    return turnover.band_permanence(charts.daily_chart(spark, sf_dir))


@query
def market_diagnostics(spark, sf_dir):
    chart = charts.daily_chart(spark, sf_dir)
    return turnover.market_diagnostics(chart, min_rows=MARKET_ROWS)


def _diagnostics_with_anomaly(spark, sf_dir):
    chart = charts.daily_chart_with_anomaly(spark, sf_dir)
    return turnover.market_diagnostics(chart, min_rows=MARKET_ROWS)


@query
def market_anomalies(spark, sf_dir):
    return turnover.anomalous_markets(_diagnostics_with_anomaly(spark, sf_dir))


@query
def market_volatility(spark, sf_dir):
    return turnover.volatile_markets(_diagnostics_with_anomaly(spark, sf_dir), limit=15)


@query
def market_stable(spark, sf_dir):
    return turnover.stable_markets(
        turnover.volatile_markets(_diagnostics_with_anomaly(spark, sf_dir)), limit=3
    )


# Labels and releases on the weekly chart.


@query
def label_top10(spark, sf_dir):
    return releases.label_top(charts.weekly_with_brand(spark, sf_dir))


@query
def label_no1(spark, sf_dir):
    return releases.label_first(charts.weekly_with_brand(spark, sf_dir))


@query
def label_top10_raw(spark, sf_dir):
    """Labels of the raw weekly table, some of them blank or missing."""
    return releases.label_top(readers.albums_weekly(charts.weekly_raw_with_brand(spark, sf_dir)))


@query
def release_lag(spark, sf_dir):
    return releases.release_lag(charts.weekly_with_release(spark, sf_dir))


@query
def release_lag_facts(spark, sf_dir):
    return releases.release_lag_facts(release_lag(spark, sf_dir))


@query
def debut_permanence(spark, sf_dir):
    return releases.debut_permanence(charts.weekly_ranks(spark, sf_dir))


@query
def debut_facts(spark, sf_dir):
    return releases.debut_facts(debut_permanence(spark, sf_dir))


@query
def executive_facts(spark, sf_dir):
    daily = charts.daily_chart(spark, sf_dir)
    weekly = charts.weekly_chart(spark, sf_dir)
    diversity = leadership.leader_diversity(daily)
    return facts.executive_facts(
        leadership.leader_share(leadership.leaders(daily)),
        turnover.turnover_facts(turnover.top_status(daily)),
        leadership.leader_diversity_facts(diversity),
        turnover.band_permanence(daily),
        releases.label_top(weekly),
        releases.release_lag_facts(releases.release_lag(weekly)),
        releases.debut_facts(releases.debut_permanence(weekly)),
    ).drop("text")


# Raw tables: parsing, quality, coverage and profiles.


@query
def safe_parse(spark, sf_dir):
    raw = charts.daily_raw(spark, sf_dir)
    return raw.select(
        *["uri", "country", "entry_date"],
        F.col("date").alias("date_text"),
        F.col("rank").alias("rank_text"),
        F.col("days_on_chart").alias("days_text"),
        safe_date("date").alias("fecha"),
        safe_int("rank").alias("rank"),
        safe_int("days_on_chart").alias("days_on_chart"),
    )


@query
def typed_albums(spark, sf_dir):
    return readers.albums_weekly(charts.weekly_raw(spark, sf_dir))


@query
def quality(spark, sf_dir):
    artists = readers.artists_daily(charts.daily_raw(spark, sf_dir))
    albums = readers.albums_weekly(charts.weekly_raw(spark, sf_dir))
    return profiling.quality_report(artists, albums)


@query
def coverage(spark, sf_dir):
    artists = readers.artists_daily(charts.daily_raw(spark, sf_dir))
    albums = readers.albums_weekly(charts.weekly_raw(spark, sf_dir))
    return profiling.union_tables(
        [
            profiling.coverage(artists, "Artistas diarios"),
            profiling.coverage(albums, "Albumes semanales"),
        ]
    )


def _summary(spark, sf_dir, name):
    df = charts.table(spark, sf_dir, name)
    return profiling.table_summary(df, name, f"{name}.parquet").drop("file_path")


@query
def table_profile(spark, sf_dir):
    return _summary(spark, sf_dir, "lineitem")


@query
def summary_union(spark, sf_dir):
    return profiling.union_tables([_summary(spark, sf_dir, name) for name in TABLES])


@query
def null_profile(spark, sf_dir):
    return profiling.null_profile(readers.artists_daily(charts.daily_raw(spark, sf_dir)))


@query
def schema_rows(spark, sf_dir):
    return profiling.schema_rows(charts.table(spark, sf_dir, "lineitem")).drop("nullable")


@query
def numeric_moments(spark, sf_dir):
    return profiling.numeric_summary(charts.table(spark, sf_dir, "lineitem"), quartiles=False)


@query
def numeric_summary(spark, sf_dir):
    return profiling.numeric_summary(charts.table(spark, sf_dir, "lineitem"))


@query
def numeric_quartiles(spark, sf_dir):
    return profiling.exact_quartiles(charts.table(spark, sf_dir, "lineitem"))


@query
def line_quartiles(spark, sf_dir):
    """Exact quartiles of prices in groups that hold up to half of all rows."""
    lines = charts.table(spark, sf_dir, "lineitem")
    return quantiles.exact_quantiles(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice")


LANDED_FROM = "1998-01"

# Files: what a user starts with and ends with, written and read back.


def _fresh(spark, name):
    return f"{shared_folder(spark)}/rankscope-{name}-{uuid4()}"


def _as_text(spark, raw, columns):
    """A raw chart written as gzip CSV and read back, every column a string."""
    path = _fresh(spark, "raw.csv")
    sinks.write_text_csv(raw, path)
    return readers.read_text_csv(spark, path, columns)


@query
def csv_round_trip(spark, sf_dir):
    raw = _as_text(spark, charts.daily_raw(spark, sf_dir), v.ARTISTS_DAILY_COLUMNS)
    return readers.artists_daily(raw)


@query
def inferred_profile(spark, sf_dir):
    """Types found by inference in a CSV file, and what its columns hold."""
    path = _fresh(spark, "part.csv")
    sinks.write_text_csv(charts.table(spark, sf_dir, "part"), path, gzip=False)
    return profiling.schema_rows(readers.read_inferred_csv(spark, path)).drop("nullable")


@query
def landed_months(spark, sf_dir):
    """Rows of the landed weekly chart from a month on; only these months' folders are read."""
    path = _fresh(spark, "landed")
    raw = _as_text(spark, charts.weekly_raw(spark, sf_dir), v.ALBUMS_WEEKLY_COLUMNS)
    sinks.land_chart(readers.albums_weekly(raw), path)
    later = spark.read.parquet(path).filter(F.col("month") >= LANDED_FROM)
    return later.groupBy("month").agg(F.count("*").alias("rows"), F.min("fecha").alias("first_date"))


@query
def duplicates(spark, sf_dir):
    lines = charts.table(spark, sf_dir, "lineitem")
    return profiling.duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


# The cohort study on the monthly chart.


def _once(spark, sf_dir, name, tables, build):
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]
    return stored_once(spark, f"{name} {SETTINGS}", paths, build)


MONTHLY = ("lineitem", "supplier", "nation")


def _people(spark, sf_dir):
    def build():
        return study_population(charts.monthly_chart(spark, sf_dir), SETTINGS)

    return _once(spark, sf_dir, "people", MONTHLY, build)


def _drawn(spark, sf_dir):
    return _once(spark, sf_dir, "drawn", MONTHLY, lambda: study_sample(_people(spark, sf_dir), SETTINGS))


def _with_folds(spark, sf_dir):
    return _once(spark, sf_dir, "folded", MONTHLY, lambda: study_folds(_drawn(spark, sf_dir), SETTINGS))


@query
def population_audit(spark, sf_dir):
    return profiling.population_audit(charts.monthly_chart(spark, sf_dir))


@query
def entity_profile(spark, sf_dir):
    history = cohort.without_market(charts.monthly_chart(spark, sf_dir), SETTINGS.excluded)
    return cohort.entity_profile(
        history, veteran_after=SETTINGS.veteran_after, global_after=SETTINGS.global_after
    )


@query
def population(spark, sf_dir):
    return _people(spark, sf_dir)


@query
def strata(spark, sf_dir):
    return cohort.strata(_people(spark, sf_dir), SETTINGS.target)


@query
def sample_exact(spark, sf_dir):
    return _drawn(spark, sf_dir)


@query
def sample_bernoulli(spark, sf_dir):
    people = _people(spark, sf_dir)
    return sampling.sample_bernoulli(people, cohort.strata(people, SETTINGS.target))


@query
def strata_compare(spark, sf_dir):
    return sampling.compare_strata(strata(spark, sf_dir), _drawn(spark, sf_dir))


@query
def written_strata(spark, sf_dir):
    """The comparison as a result file and back, with its column types."""
    folder = _fresh(spark, "results")
    sinks.write_tables({"strata": strata_compare(spark, sf_dir)}, folder)
    return sinks.read_table(spark, folder, "strata")


@query
def written_document(spark, sf_dir):
    """Sample and fold checks as one JSON document and back."""
    path = _fresh(spark, "document")
    checks = fold_checks(spark, sf_dir).select(
        F.struct("folds_distintos", "fold_min", "fold_max").alias("folds"),
        F.struct("unique_ids", "all_strata_in_folds", "five_balanced_folds").alias("integrity"),
    )
    sinks.write_document(checks, path)
    return sinks.read_document(spark, path).select("folds.*", "integrity.*")


@query
def sample_checks(spark, sf_dir):
    return sampling.sample_checks(
        strata_compare(spark, sf_dir), _drawn(spark, sf_dir), SETTINGS.target
    )


@query
def critical_nulls(spark, sf_dir):
    return sampling.critical_nulls(_people(spark, sf_dir))


@query
def folds(spark, sf_dir):
    columns = ["id", "partition_id", "country", "artist_uri", "date", "fold_id"]
    return _with_folds(spark, sf_dir).select(*columns)


@query
def fold_sizes(spark, sf_dir):
    return sampling.fold_sizes(_with_folds(spark, sf_dir))


@query
def split_sizes(spark, sf_dir):
    return sampling.split_sizes(_with_folds(spark, sf_dir))


@query
def fold_pivot(spark, sf_dir):
    return sampling.fold_pivot(_with_folds(spark, sf_dir))


@query
def fold_checks(spark, sf_dir):
    return sampling.fold_checks(_with_folds(spark, sf_dir))


@query
def class_share(spark, sf_dir):
    return sampling.class_share(_with_folds(spark, sf_dir))


@query
def class_weights(spark, sf_dir):
    sample = _with_folds(spark, sf_dir).withColumn("label", F.col("rank_tier"))
    return evaluation.class_weights(evaluation.label_counts(sample))


@query
def label_index(spark, sf_dir):
    with kept(_with_folds(spark, sf_dir)) as sample:
        _, model = forest.add_features(sample)
    return forest.category_index(model, spark)


@query
def scaled(spark, sf_dir):
    rows, _ = segments.scale(_with_folds(spark, sf_dir))
    return segments.scaled_columns(rows, ["id"])


#: centres in the scaled space of the four cluster features, and a small forest over three of them
CENTRES = ((-0.8, -0.9, -0.7, 0.4), (0.9, 0.6, 0.5, -0.6), (0.1, 0.4, 0.8, 1.1))
FOREST = {
    0: [(0, 0, 3.0, 1, 2, (50, 50)), (1, 1, 6.0, 3, 4, (30, 10)), (2, None, None, None, None, (8, 32)),
        (3, None, None, None, None, (27, 3)), (4, None, None, None, None, (5, 5))],
    1: [(0, 2, 14.0, 1, 2, (60, 40)), (1, None, None, None, None, (45, 15)), (2, 0, 5.0, 3, 4, (15, 25)),
        (3, None, None, None, None, (10, 10)), (4, None, None, None, None, (3, 17))],
    2: [(0, None, None, None, None, (3, 1))],
}


def _fixed_clusters(spark, sf_dir):
    rows, _ = segments.scale(_with_folds(spark, sf_dir))
    names = [f"{c}_scaled" for c in v.CLUSTER_FEATURES]
    flat = segments.scaled_columns(rows, v.CLUSTER_FEATURES)
    return segments.profile_clusters(flat, CENTRES, names, v.CLUSTER_FEATURES)


@query
def fixed_clusters(spark, sf_dir):
    """Sizes, cost, silhouette and centroids of clusters around given centres."""
    return _fixed_clusters(spark, sf_dir)


@query
def fixed_cluster_score(spark, sf_dir):
    return segments.score_clusters(_fixed_clusters(spark, sf_dir))


@query
def tree_scores(spark, sf_dir):
    """The sample scored by a given forest, held as a table of nodes."""
    rows = _with_folds(spark, sf_dir)
    features = F.array(*[F.col(c).cast("double") for c in v.CLUSTER_FEATURES[:3]])
    return trees.score_trees(rows, trees.fixed_nodes(spark, FOREST), "id", features, classes=2)


@query
def run_summary(spark, sf_dir):
    """Sample and folds of the study, then the fixed classifier's scores."""
    sample = _with_folds(spark, sf_dir)
    of_sample = report.sample_summary(_drawn(spark, sf_dir), sampling.fold_sizes(sample))
    return of_sample.unionByName(
        report.model_summary(metrics_summary(spark, sf_dir), best_fold(spark, sf_dir))
    )


@query
def composition(spark, sf_dir):
    """Share of the strata in each market, as for clusters."""
    return segments.composition(_people(spark, sf_dir), STRATA, row="country", percent=True)


# Evaluation of a fixed classifier.


@query
def confusion(spark, sf_dir):
    return evaluation.confusion(charts.predictions(spark, sf_dir))


@query
def confusion_total(spark, sf_dir):
    return evaluation.confusion_total(confusion(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    """Of the fold that scores best."""
    fold = best_fold(spark, sf_dir).first()["fold_id"]
    return evaluation.confusion_matrix(confusion(spark, sf_dir), fold, CLASSES)


@query
def per_class(spark, sf_dir):
    return evaluation.per_class(confusion(spark, sf_dir), CLASSES)


def _running(spark, sf_dir):
    def build():
        return roc.running_counts(roc.score_counts(charts.predictions(spark, sf_dir)))

    return _once(spark, sf_dir, "running", ("documents", "labels"), build)


@query
def roc_points(spark, sf_dir):
    return roc.roc_points(_running(spark, sf_dir))


@query
def auc(spark, sf_dir):
    return roc.roc_auc(_running(spark, sf_dir))


@query
def auc_summary(spark, sf_dir):
    return roc.auc_summary(auc(spark, sf_dir))


@query
def metrics(spark, sf_dir):
    scores = evaluation.fold_metrics(confusion(spark, sf_dir))
    return scores.join(auc(spark, sf_dir), "fold_id")


@query
def metrics_long(spark, sf_dir):
    return evaluation.metrics_long(metrics(spark, sf_dir))


@query
def metrics_summary(spark, sf_dir):
    return evaluation.metrics_summary(metrics(spark, sf_dir))


@query
def majority_baseline(spark, sf_dir):
    return evaluation.majority_baseline(
        evaluation.label_counts(charts.predictions(spark, sf_dir))
    )


@query
def model_vs_baseline(spark, sf_dir):
    return evaluation.model_vs_baseline(metrics(spark, sf_dir), majority_baseline(spark, sf_dir))


@query
def best_fold(spark, sf_dir):
    return evaluation.best_fold(metrics(spark, sf_dir))


# Fitted models: seeded, so compared by tolerance tests rather than with SQL.


def _fitted(spark, sf_dir, name, build):
    """The result tables of a fit on the monthly sample; fitted once for all queries on the same files."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in MONTHLY]
    return tables_once(spark, f"{name} {SETTINGS}", paths, build)


def _cross_validated(spark, sf_dir):
    """Tables of a cross validation at the setting that tuning on fold 0 selects."""

    def build():
        with kept(_with_folds(spark, sf_dir)) as sample:
            featured, model = forest.add_features(sample)
            forest.check_bins(model)
            positive = forest.positive_label(forest.label_names(model))
            with kept(featured) as features:
                tuned = forest.tune(features, SETTINGS.grid, positive=positive)
                chosen = tuned.first()
                cv = forest.cross_validate(features, chosen["numTrees"], chosen["maxDepth"], positive=positive)
                baseline = evaluation.majority_baseline(evaluation.label_counts(features))
                made = {
                    "tuning": tuned, "metrics": small(cv.metrics), "importances": cv.importances, "baseline": small(baseline),
                }
                cv.release()
        return made

    return _fitted(spark, sf_dir, "forest", build)


@query
def forest_cv(spark, sf_dir):
    return _cross_validated(spark, sf_dir)["metrics"]


@query
def forest_vs_baseline(spark, sf_dir):
    tables = _cross_validated(spark, sf_dir)
    return evaluation.model_vs_baseline(tables["metrics"], tables["baseline"])


@query
def importance(spark, sf_dir):
    return forest.importance_summary(_cross_validated(spark, sf_dir)["importances"])


@query
def tuning(spark, sf_dir):
    return _cross_validated(spark, sf_dir)["tuning"]


def _clustered(spark, sf_dir):
    """Tables of the sweep over k and of the clustering that it selects."""

    def build():
        with kept(_with_folds(spark, sf_dir)) as sample:
            scaled_rows, scaler = segments.scale(sample)
            columns = [segments.SCALED, "partition_id", *v.CLUSTER_FEATURES]
            with kept(scaled_rows.select(*columns)) as rows:
                fit = segments.cluster(rows, scaler)
                cells = fit.clustered.groupBy("prediction", "partition_id").count()
                return {
                    "sweep": fit.sweep, "centroids": small(fit.centroids), "sizes": small(fit.sizes), "cells": small(cells),
                }

    return _fitted(spark, sf_dir, "clusters", build)


@query
def kmeans_sweep(spark, sf_dir):
    return _clustered(spark, sf_dir)["sweep"]


@query
def clusters(spark, sf_dir):
    return _clustered(spark, sf_dir)["centroids"]


@query
def cluster_composition(spark, sf_dir):
    cells = _clustered(spark, sf_dir)["cells"]
    return segments.composition_of(cells, STRATA, percent=True)


@query
def cluster_totals(spark, sf_dir):
    """Rows and percent over all clusters of the fit."""
    totals = [F.sum("count").alias("rows"), F.sum("pct").alias("pct")]
    return _clustered(spark, sf_dir)["sizes"].agg(*totals)


@query
def cluster_strata(spark, sf_dir):
    """Rows per stratum over all clusters of the fit."""
    cells = segments.composition_of(_clustered(spark, sf_dir)["cells"], STRATA)
    rows = cells.unpivot(["prediction"], [f"`{s}`" for s in STRATA], "partition_id", "n")
    return rows.groupBy("partition_id").agg(F.sum("n").alias("rows"))
