"""Classification metrics from counts.

Predictions are counted once per fold, label and prediction. Every metric, weight and baseline below
is arithmetic on such small tables, so the rows themselves are read once for all folds together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.aggregates import ratio_or_zero


def confusion(
    predictions: DataFrame,
    fold: str = "fold_id",
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Rows per fold, label and prediction."""
    return predictions.groupBy(fold, label, prediction).count()


def confusion_total(
    counts: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The confusion counts of all folds together."""
    totals = counts.groupBy(label, prediction).agg(F.sum("count").alias("count"))
    return totals.orderBy(label, prediction)


def confusion_matrix(
    counts: DataFrame, fold: int, classes: Mapping[float, str]
) -> DataFrame:
    """The counts of one fold with class names: a row per true class, a column per prediction."""
    names = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    named = counts.filter(F.col("fold_id") == fold).select(
        "label",
        F.try_element_at(names, F.col("label")).alias("class"),
        F.try_element_at(names, F.col("prediction")).alias("predicted"),
        "count",
    )
    matrix = named.groupBy("label", "class").pivot("predicted", list(classes.values()))
    return matrix.agg(F.sum("count")).na.fill(0).orderBy("label").drop("label")


def class_counts(counts: DataFrame, *group: str) -> DataFrame:
    """True positives, support and times predicted per class, from confusion counts.

    Each cell counts for its true class and for its predicted class.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    views = F.inline(
        F.array(
            F.struct(
                F.col("label").alias("class_label"),
                hit.alias("tp"),
                F.col("count").alias("support"),
                F.lit(0).cast("long").alias("predicted"),
            ),
            F.struct(
                F.col("prediction").alias("class_label"),
                F.lit(0).cast("long").alias("tp"),
                F.lit(0).cast("long").alias("support"),
                F.col("count").alias("predicted"),
            ),
        )
    )
    return (
        counts.select(*group, views)
        .groupBy(*group, "class_label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )


def with_class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class; 0 where a denominator is 0."""
    precision, recall = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", ratio_or_zero(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio_or_zero(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio_or_zero(2 * precision * recall, precision + recall))
    )


def per_class(counts: DataFrame, classes: Mapping[float, str]) -> DataFrame:
    """Support, precision, recall and F1 of each class over all folds, with the class name.

    ``classes`` maps a label to its name. Only classes that occur as labels are listed.
    """
    names = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    return (
        with_class_scores(class_counts(counts))
        .filter(F.col("support") > 0)
        .select(
            F.col("class_label").alias("label"),
            F.try_element_at(names, F.col("class_label")).alias("class"),
            *["support", "precision", "recall", "f1"],
        )
        .orderBy("label")
    )


def fold_metrics(counts: DataFrame, fold: str = "fold_id") -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall per fold."""
    scored = with_class_scores(class_counts(counts, fold))

    def weighted(name: str):
        return F.sum(F.col(name) * F.col("support")) / F.sum("support")

    return (
        scored.groupBy(fold)
        .agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            weighted("f1").alias("f1_weighted"),
            weighted("precision").alias("precision_weighted"),
            weighted("recall").alias("recall_weighted"),
            F.sum("support").alias("n_test"),
        )
        .orderBy(fold)
    )


def label_counts(
    sample: DataFrame, folds: int = v.FOLDS, fold: str = "fold_id", label: str = "label"
) -> DataFrame:
    """Per fold and label: its rows as test data and, over the other folds, as training data.

    Each of the few counted cells is a test count for its own fold and a training count for every
    other one, so a label that a fold does not hold is listed too.
    """
    cells = sample.groupBy(F.col(fold).alias("own"), label).count()
    as_fold = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias(fold)
    is_test = F.col(fold) == F.col("own")
    n_test = F.when(is_test, F.col("count")).otherwise(0)
    n_train = F.when(~is_test, F.col("count")).otherwise(0)
    return (
        cells.select("*", as_fold)
        .groupBy(fold, label)
        .agg(F.sum(n_test).alias("n_test"), F.sum(n_train).alias("n_train"))
    )


def class_weights(counts: DataFrame, fold: str = "fold_id") -> DataFrame:
    """Balanced weight ``rows / (classes * rows of the class)`` of each label in training.

    ``counts`` is the result of ``label_counts``: the training rows of a fold are those of all
    others. A label without training rows has no weight.
    """
    of_fold = Window.partitionBy(fold)
    present = counts.filter(F.col("n_train") > 0)
    weight = F.sum("n_train").over(of_fold) / (F.count("*").over(of_fold) * F.col("n_train"))
    return present.withColumn("weight", weight).select(fold, "label", "n_train", "weight")


def majority_baseline(counts: DataFrame, fold: str = "fold_id") -> DataFrame:
    """Metrics per fold of always predicting the label most frequent in training.

    ``counts`` is the result of ``label_counts``. Predicting one label for a whole fold fixes its
    confusion counts, so no row is scored. Equal labels go to the smaller; the area is 0.5 by
    definition.
    """
    majority = F.min_by("label", F.struct(-F.col("n_train"), F.col("label")))
    labels = counts.withColumn("prediction", majority.over(Window.partitionBy(fold)))
    cells = labels.select(fold, "label", "prediction", F.col("n_test").alias("count"))
    predicted = labels.groupBy(fold).agg(F.max("prediction").alias("majority_label"))
    return (
        fold_metrics(cells, fold)
        .join(predicted, fold)
        .select(
            *["accuracy", "f1_weighted", "precision_weighted", "recall_weighted"],
            F.lit(0.5).alias("auc_roc"),
            fold,
            "majority_label",
        )
        .orderBy(fold)
    )


def metrics_long(metrics: DataFrame, fold: str = "fold_id") -> DataFrame:
    """One row per fold and metric."""
    return metrics.unpivot(fold, list(v.METRICS), "metric", "value")


def metrics_summary(metrics: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean, sample deviation and bounds of each metric over the folds, metrics in order."""
    stats = (
        metrics_long(metrics)
        .groupBy("metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    if scale is not None:
        stats = stats.select("metric", *[F.bround(c, scale).alias(c) for c in stats.columns[1:]])
    return stats.orderBy(F.array_position(F.array(*[F.lit(m) for m in v.METRICS]), F.col("metric")))


def model_vs_baseline(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """Both summaries side by side and the difference of the means."""
    base = metrics_summary(baseline).select(
        "metric", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")
    )
    delta = (F.col("mean") - F.col("baseline_mean")).alias("delta_model_minus_baseline")
    joined = metrics_summary(metrics).join(base, "metric")
    order = F.array_position(F.array(*[F.lit(m) for m in v.METRICS]), F.col("metric"))
    return joined.select("*", delta).orderBy(order)


def best_fold(metrics: DataFrame) -> DataFrame:
    """The row of the fold with the largest area, then the largest F1, then the smaller number."""
    return metrics.orderBy(F.desc("auc_roc"), F.desc("f1_weighted"), "fold_id").limit(1)
