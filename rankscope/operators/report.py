"""The closing tables of the cohort study: a key-value summary and one nested document."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.text import thousands_text
from rankscope.operators.sampling import COMPLETE

_SCORE_MAP = "map<string,double>"
DOCUMENT_SCHEMA = f"""
    dataset struct<original_records:bigint, date_min:string, date_max:string,
        filtered_records:bigint, excluded_country:string, evaluation_start:string>,
    sample struct<target:bigint, actual:bigint, clean:bigint, strata:bigint,
        max_population_sample_difference_pct:double>,
    folds struct<count:bigint, minimum_size:bigint, maximum_size:bigint>,
    random_forest struct<selected_numTrees:int, selected_maxDepth:int, best_fold:int,
        best_fold_selection_rule:string, metrics_mean:{_SCORE_MAP}, metrics_std:{_SCORE_MAP},
        baseline_mean:{_SCORE_MAP}, model_minus_baseline:{_SCORE_MAP},
        per_class:map<string,struct<support:bigint, precision:double, recall:double, f1:double>>>,
    kmeans struct<best_k:int, silhouette:double, inertia:double>,
    integrity struct<all_eight_strata:boolean, five_balanced_folds:boolean, unique_ids:boolean,
        rank_excluded_from_supervised_features:boolean>
"""


def items(one_row: DataFrame, entries: dict[str, Column]) -> DataFrame:
    """``(item, value)`` rows from the columns of a one-row table, every value as text."""
    wide = one_row.select(*[c.cast("string").alias(name) for name, c in entries.items()])
    return wide.unpivot([], list(entries), "item", "value")


def sample_summary(sample: DataFrame, folds: DataFrame) -> DataFrame:
    """Sample size, number of folds and the smallest and largest fold, as text.

    ``folds`` is the result of ``fold_sizes``.
    """
    sizes = folds.agg(
        F.count("*").alias("folds"), F.min("count").alias("low"), F.max("count").alias("high")
    )
    complete = reduce(and_, [F.col(name).isNotNull() for name in COMPLETE])
    rows = sample.agg(F.count("*").alias("n"), F.count_if(complete).alias("clean"))
    return items(
        rows,
        {
            "sample_rows": thousands_text(F.col("n")),
            "clean_rows": thousands_text(F.col("clean")),
        },
    ).unionByName(
        items(
            sizes,
            {
                "folds": F.col("folds"),
                "smallest_fold": thousands_text(F.col("low")),
                "largest_fold": thousands_text(F.col("high")),
            },
        )
    )


def model_summary(summary: DataFrame, best: DataFrame) -> DataFrame:
    """Best fold, and mean and deviation of area and F1, as text with four decimals.

    ``summary`` is the result of ``metrics_summary``, ``best`` that of ``best_fold``.
    """
    chosen = summary.filter(F.col("metric").isin("auc_roc", "f1_weighted"))
    stats = chosen.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.concat("metric", F.lit(f"_{stat}")).alias("item"),
                        F.format_string("%.4f", F.col(stat)).alias("value"),
                    )
                    for stat in ("mean", "std")
                ]
            )
        )
    )
    return items(best, {"best_fold": F.col("fold_id")}).unionByName(stats)


def metrics_document(
    audit: DataFrame,
    sample_check: DataFrame,
    fold_check: DataFrame,
    best_setting: tuple[int, int],
    comparison: DataFrame,
    best: DataFrame,
    classes: DataFrame,
    clusters: tuple[int, float, float],
    filtered_records: int,
    features: Sequence[str] = v.FEATURES,
    target: int = v.SAMPLE_TARGET,
    excluded: str = v.EXCLUDED_MARKET,
    start: str = v.EVALUATION_START,
) -> DataFrame:
    """One nested row with the study's headline numbers, from its finished result tables.

    Each input holds at most a row per metric or class.
    """
    a, s, f = audit.first(), sample_check.first(), fold_check.first()
    scores = comparison.collect()

    def by_metric(column: str) -> dict[str, float]:
        return {r["metric"]: r[column] for r in scores}

    forest = (
        *best_setting,
        best.first()["fold_id"],
        "largest auc_roc, then largest f1_weighted",
        by_metric("mean"),
        by_metric("std"),
        by_metric("baseline_mean"),
        by_metric("delta_model_minus_baseline"),
        {r["class"]: (r.support, r.precision, r.recall, r.f1) for r in classes.collect()},
    )
    row = (
        (a.n_original, str(a.min_date), str(a.max_date), filtered_records, excluded, start),
        (target, s.n_M, s.n_M_clean, s.strata, s.max_abs_diff_pct),
        (f.folds_distintos, f.fold_min, f.fold_max),
        forest,
        clusters,
        (s.all_strata_sampled, f.five_balanced_folds, f.unique_ids, "rank" not in features),
    )
    return audit.sparkSession.createDataFrame([row], DOCUMENT_SCHEMA)
