"""Receiver operating characteristic by running totals, exact at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope.operators.ordering import bin_offsets, even_bins


def score_counts(
    predictions: DataFrame,
    fold: str = "fold_id",
    label: str = "label",
    score: str = "score",
    positive: float = 1.0,
) -> DataFrame:
    """Positive and other rows per fold and distinct score; equal scores become one point."""
    is_positive = F.col(label) == positive
    return predictions.groupBy(F.col(fold).alias("fold_id"), F.col(score).alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )


def running_counts(counts: DataFrame, bins: int = 128) -> DataFrame:
    """Adds ``tp`` and ``fp``, the counts down to each score, and the fold totals.

    A fold's distinct scores are cut into at most ``bins`` even stretches, from high scores to low; the cuts
    are a sketch of the fold, made inside the plan, and only balance the work. Totals before a stretch come
    from a table of one row per fold and stretch, so no task sorts a whole fold.
    """
    binned = even_bins(counts, "fold_id", "score", bins).withColumn("__bin", -F.col("__bin"))
    totals = {"pos": F.sum("pos"), "neg": F.sum("neg")}
    offsets = bin_offsets(binned, "fold_id", "__bin", totals).drop("pos_in", "neg_in")
    within = Window.partitionBy("fold_id", "__bin").orderBy(F.desc("score"))
    return (
        binned.join(offsets, ["fold_id", "__bin"])
        .withColumn("tp", F.col("pos_before") + F.sum("pos").over(within))
        .withColumn("fp", F.col("neg_before") + F.sum("neg").over(within))
        .drop("__bin", "pos_before", "neg_before")
    )


def roc_points(running: DataFrame) -> DataFrame:
    """Rates at each distinct score, after a start at (0, 0); 0 where a fold lacks a class."""
    points = running.select("fold_id", "score", "tp", "fp", "pos_all", "neg_all")
    start = points.groupBy("fold_id").agg(
        F.lit(float("inf")).alias("score"),
        *[F.lit(0).cast("long").alias(c) for c in ("tp", "fp")],
        *[F.max(c).alias(c) for c in ("pos_all", "neg_all")],
    )
    return points.unionByName(start).select(
        *["fold_id", "score", "tp", "fp"],
        F.coalesce(F.try_divide("tp", "pos_all"), F.lit(0.0)).alias("tpr"),
        F.coalesce(F.try_divide("fp", "neg_all"), F.lit(0.0)).alias("fpr"),
    )


def roc_auc(running: DataFrame) -> DataFrame:
    """Area under each fold's curve by trapezoids; NULL where a fold lacks a class.

    A score adds a strip as wide as its negatives, under the middle of its rise in positives. The
    strips are doubled to whole numbers, so their sum does not depend on its order.
    """
    strip = F.col("neg").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("pos"))
    twice = F.sum(strip).cast("double")
    area = F.try_divide(twice, 2.0 * F.max("pos_all").cast("double") * F.max("neg_all"))
    return running.groupBy("fold_id").agg(area.alias("auc_roc")).orderBy("fold_id")


def auc_summary(areas: DataFrame) -> DataFrame:
    """One row: mean and sample deviation of the fold areas."""
    return areas.agg(F.avg("auc_roc").alias("auc_mean"), F.stddev_samp("auc_roc").alias("auc_std"))
