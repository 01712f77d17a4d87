"""The three programs a user runs: the table audit, the insights and the cohort study."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.banding import all_strata
from rankscope.operators import cohort, evaluation, facts, forest, leadership, profiling
from rankscope.operators import releases, report, sampling, segments, turnover
from rankscope.session import kept
from rankscope.sources import readers, registry, sinks


def run_audit(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Profile every expected file that is present and write the profiles as parquet.

    Returns the combined summary: one row per table. Raises if no file is there.
    """
    present = registry.present_files(registry.file_status(spark, folder))
    if not present:
        raise FileNotFoundError(f"no table in {folder}")
    summaries = []
    for name, path in present.items():
        df = readers.read_inferred_csv(spark, path)
        summary = profiling.table_summary(df, name, path.rsplit("/", 1)[-1], path)
        sinks.write_parquet(summary, f"{out}/{name}_summary.parquet")
        sinks.write_parquet(profiling.null_profile(df), f"{out}/{name}_nulls.parquet")
        numbers = profiling.numeric_summary(df)
        if numbers is not None:
            sinks.write_parquet(numbers, f"{out}/{name}_numeric_summary.parquet")
        summaries.append(spark.read.parquet(f"{out}/{name}_summary.parquet"))
    combined = profiling.union_tables(summaries).orderBy("table_name")
    sinks.write_parquet(combined, f"{out}/combined_table_summary.parquet")
    return combined


def run_insights(
    artists: DataFrame,
    albums: DataFrame,
    min_days: int = 150,
    local_until: int = 3,
    global_from: int = 20,
    min_rows: int = 1000,
) -> dict[str, DataFrame]:
    """All insight tables of the two typed charts, lazily."""
    first = leadership.leaders(artists)
    status = turnover.top_status(artists)
    diversity = leadership.leader_diversity(artists)
    permanence = turnover.band_permanence(artists)
    diagnostics = turnover.market_diagnostics(artists, min_rows=min_rows)
    volatility = turnover.volatile_markets(diagnostics)
    labels = releases.label_top(albums)
    lags = releases.release_lag(albums)
    debut = releases.debut_permanence(albums)
    return {
        "coverage": profiling.union_tables(
            [
                profiling.coverage(artists, "Artistas diarios"),
                profiling.coverage(albums, "Albumes semanales"),
            ]
        ),
        "quality": profiling.quality_report(artists, albums),
        "leaders": first,
        "leader_share": leadership.leader_share(first),
        "leader_reach": leadership.leader_reach(
            first, min_days=min_days, local_until=local_until, global_from=global_from
        ),
        "top10_status": status,
        "turnover": turnover.turnover_facts(status),
        "band_permanence": permanence,
        "leader_diversity": diversity,
        "market_diagnostics": diagnostics,
        "market_anomalies": turnover.anomalous_markets(diagnostics),
        "market_volatility": volatility,
        "market_stable": turnover.stable_markets(volatility),
        "label_top10": labels,
        "label_no1": releases.label_first(albums),
        "release_lag": lags,
        "debut_permanence": debut,
        "executive_facts": facts.executive_facts(
            leadership.leader_share(first),
            turnover.turnover_facts(status),
            leadership.leader_diversity_facts(diversity),
            permanence,
            labels,
            releases.release_lag_facts(lags),
            releases.debut_facts(debut),
        ),
    }


@dataclass(frozen=True)
class StudySettings:
    """Thresholds of the cohort study; the defaults are those of the published tables."""

    excluded: str = v.EXCLUDED_MARKET
    start: str = v.EVALUATION_START
    veteran_after: int = v.VETERAN_AFTER
    global_after: int = v.GLOBAL_AFTER
    top_until: int = v.TOP_UNTIL
    target: int = v.SAMPLE_TARGET
    folds: int = v.FOLDS
    seed: int = v.SEED
    grid: tuple[tuple[int, int], ...] = v.FOREST_GRID
    cluster_counts: tuple[int, ...] = v.CLUSTER_COUNTS
    expected_strata: int = 8


@dataclass
class Study:
    """Result tables by the names they are written under, and the metrics document."""

    document: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def write(self, folder: str) -> None:
        sinks.write_tables(self.tables, folder)
        sinks.write_document(self.document, f"{folder.rstrip('/')}/final_metrics")


def study_population(chart: DataFrame, settings: StudySettings) -> DataFrame:
    return cohort.population(
        chart,
        excluded=settings.excluded,
        start=settings.start,
        veteran_after=settings.veteran_after,
        global_after=settings.global_after,
        top_until=settings.top_until,
    )


def study_sample(people: DataFrame, settings: StudySettings) -> DataFrame:
    """The exact stratified sample as it is drawn."""
    return sampling.sample_exact(people, settings.target, seed=settings.seed)


def study_folds(sample: DataFrame, settings: StudySettings) -> DataFrame:
    """The complete rows of the sample, with ids and folds."""
    clean = sampling.with_row_id(sampling.complete_rows(sample), seed=settings.seed)
    return sampling.assign_folds(clean, settings.folds, seed=settings.seed)


def small(df: DataFrame) -> DataFrame:
    """A result table of a few rows, computed once and held as rows of the plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def run_study(chart: DataFrame, settings: StudySettings | None = None) -> Study:
    """Population, sample, folds, forest, baseline and clusters, from the six study columns.

    Population, sample and predictions are read many times, so they are persisted while it runs.
    Their lineage stays: what is lost with an executor is computed again.
    """
    s = settings or StudySettings()
    with kept(study_population(chart, s)) as people, kept(study_sample(people, s)) as drawn:
        with kept(study_folds(drawn, s)) as sample:
            return _study(chart, people, drawn, sample, s)


def _study(
    chart: DataFrame, people: DataFrame, drawn: DataFrame, sample: DataFrame, s: StudySettings
) -> Study:
    strata = small(cohort.strata(people, s.target))
    compared = small(sampling.compare_strata(strata, drawn))
    sizes = small(sampling.fold_sizes(sample))
    tables = {"strata": compared, "folds": sizes}

    featured, model = forest.add_features(sample)
    forest.check_bins(model)
    names = forest.label_names(model)
    positive = forest.positive_label(names)
    with kept(featured) as features:
        tuned = forest.tune(features, s.grid, 0, s.folds, s.seed, positive)
        trees, depth = tuned.select("numTrees", "maxDepth").first()
        cv = forest.cross_validate(features, trees, depth, s.folds, s.seed, positive)
        metrics = small(cv.metrics)
        counts = small(cv.confusion)
        baseline = small(
            evaluation.majority_baseline(evaluation.label_counts(features, s.folds))
        )
        cv.release()
    best = evaluation.best_fold(metrics)
    classes = evaluation.per_class(counts, names)
    versus = evaluation.model_vs_baseline(metrics, baseline)
    tables |= {
        "tuning": tuned,
        "fold_metrics": metrics,
        "baseline_folds": baseline,
        "model_vs_baseline": versus,
        "per_class": classes,
        "summary": evaluation.metrics_summary(metrics, scale=4),
        "confusion": evaluation.confusion_matrix(counts, best.first()["fold_id"], names),
        "importance": forest.importance_summary(cv.importances),
    }

    scaled, scaler = segments.scale(sample)
    columns = [segments.SCALED, "partition_id", *v.CLUSTER_FEATURES]
    with kept(scaled.select(*columns)) as scaled_rows:
        clusters = segments.cluster(scaled_rows, scaler, s.cluster_counts, seed=s.seed)
        tables |= {
            "kmeans": clusters.sweep,
            "cluster_sizes": small(clusters.sizes),
            "centroids": small(clusters.centroids),
            "cluster_composition": small(
                segments.composition(clusters.clustered, all_strata(), percent=True)
            ),
        }
    checks = sampling.sample_checks(compared, drawn, s.target, s.expected_strata)
    document = report.metrics_document(
        profiling.population_audit(chart),
        checks,
        sampling.fold_checks(sample, s.folds),
        (trees, depth),
        versus,
        best,
        classes,
        (clusters.k, clusters.silhouette, clusters.inertia),
        filtered_records=strata.agg(F.sum("count")).first()[0],
        target=s.target,
        excluded=s.excluded,
        start=s.start,
    )
    return Study(document, tables)
