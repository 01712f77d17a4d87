"""Metrics against the library's evaluators, brute force, and published result tables."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from rankscope.operators import cohort, evaluation, forest, report, roc, segments

COUNTS = "fold_id int, label double, prediction double, count long"
NAMES = {0.0: "Estable", 1.0: "Top"}

# Published results, as printed there.
STRATA = {
    "Veterano-Global-Estable": (7681082, 0.42876965077891394),
    "Veterano-Local-Estable": (4613304, 0.2575216284654905),
    "Veterano-Global-Top": (2730816, 0.15243829224339364),
    "Veterano-Local-Top": (1752364, 0.09781961712133014),
    "Nuevo-Local-Estable": (789060, 0.04404652634142037),
    "Nuevo-Global-Estable": (253107, 0.014128816747392954),
    "Nuevo-Local-Top": (47955, 0.002676920856085486),
    "Nuevo-Global-Top": (46551, 0.002598547445973005),
}
FOLD_3 = [(3, 0.0, 0.0, 22662), (3, 0.0, 1.0, 7134), (3, 1.0, 0.0, 3206), (3, 1.0, 1.0, 7004)]
FOLD_3_METRICS = (0.7415387691846224, 0.7532678903176058, 0.7789140365719761, 0.7415387691846222)
SUPPORT = {"Estable": 148984, "Top": 51049}
FOLD_METRICS = [
    (0, 0.7356410897275681, 0.7479896200346849, 0.7753526728470316, 0.7356410897275681,
     0.7845808354949204),
    (1, 0.7344964631189542, 0.7471755547550906, 0.7758996892371264, 0.7344964631189541,
     0.787308472607182),
    (2, 0.7446633005049242, 0.7558429829677968, 0.7796247351750227, 0.7446633005049242,
     0.788755417347266),
    (3, 0.7415387691846224, 0.7532678903176058, 0.7789140365719761, 0.7415387691846222,
     0.7911558424251939),
    (4, 0.7364013598640136, 0.7487647464380638, 0.7763436194859212, 0.7364013598640136,
     0.7886642705533464),
]
SUMMARY = {
    "accuracy": (0.7385, 0.0044, 0.7345, 0.7447),
    "f1_weighted": (0.7506, 0.0038, 0.7472, 0.7558),
    "precision_weighted": (0.7772, 0.0019, 0.7754, 0.7796),
    "recall_weighted": (0.7385, 0.0044, 0.7345, 0.7447),
    "auc_roc": (0.7881, 0.0024, 0.7846, 0.7912),
}
BASELINE_FOLD_0 = (0.7447888027993002, 0.6358481437813561, 0.5547103607752149, 0.7447888027993002)
METRIC_SCHEMA = (
    "fold_id int, accuracy double, f1_weighted double, precision_weighted double, "
    "recall_weighted double, auc_roc double"
)


def close(left, right):
    return all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(left, right, strict=True))


def test_published_strata(spark):
    counts = spark.createDataFrame(
        [(k, n) for k, (n, _) in STRATA.items()], "partition_id string, count long"
    )
    rows = {r.partition_id: r for r in cohort.strata_from_counts(counts).collect()}
    assert all(math.isclose(rows[k].probability, p) for k, (_, p) in STRATA.items())
    assert rows["Veterano-Global-Estable"].n_i == 85754
    assert rows["Nuevo-Global-Top"].n_i == 520
    assert math.isclose(rows["Nuevo-Global-Top"].fraction, 520 / 46551)


def test_quota_rounds_half_to_even_and_is_never_above_the_stratum(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5)], "partition_id string, count long")
    assert {r.n_i for r in cohort.strata_from_counts(counts, 5).collect()} == {2}
    assert {r.fraction for r in cohort.strata_from_counts(counts, 100).collect()} == {1.0}


def test_published_fold_metrics(spark):
    counts = spark.createDataFrame(FOLD_3, COUNTS)
    row = evaluation.fold_metrics(counts).first()
    assert close(row[1:5], FOLD_3_METRICS) and row.n_test == 40006
    matrix = evaluation.confusion_matrix(counts, 3, NAMES).collect()
    assert [tuple(r) for r in matrix] == [("Estable", 22662, 7134), ("Top", 3206, 7004)]


def test_published_summary_and_best_fold(spark):
    metrics = spark.createDataFrame(FOLD_METRICS, METRIC_SCHEMA)
    rows = evaluation.metrics_summary(metrics, scale=4).collect()
    assert [r.metric for r in rows] == list(SUMMARY)
    assert all(tuple(r)[1:] == SUMMARY[r.metric] for r in rows)
    assert evaluation.best_fold(metrics).first().fold_id == 3
    assert evaluation.metrics_long(metrics).count() == 25


def test_published_baseline_and_weights(spark):
    """Fold 0 of the published folds: 40,010 rows of which 29,799 are of the larger class."""
    counts = spark.createDataFrame(
        [(0, 0.0, 29799, 119185), (0, 1.0, 10211, 40838)],
        "fold_id int, label double, n_test long, n_train long",
    )
    row = evaluation.majority_baseline(counts).first()
    assert close(row[:4], BASELINE_FOLD_0)
    assert (row.auc_roc, row.majority_label) == (0.5, 0.0)
    assert math.isclose(row.precision_weighted, row.accuracy**2)
    weights = {r.label: round(r.weight, 4) for r in evaluation.class_weights(counts).collect()}
    assert weights == {0.0: 0.6713, 1.0: 1.9592}


def test_label_counts_list_a_label_the_fold_lacks(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (1, 1.0)], "fold_id int, label double")
    rows = {(r.fold_id, r.label): (r.n_test, r.n_train) for r in
            evaluation.label_counts(df, 2).collect()}
    assert rows == {(0, 0.0): (2, 0), (0, 1.0): (0, 1), (1, 0.0): (0, 2), (1, 1.0): (1, 0)}
    baseline = evaluation.majority_baseline(evaluation.label_counts(df, 2)).collect()
    assert [(r.fold_id, r.majority_label, r.accuracy) for r in baseline] == [
        (0, 1.0, 0.0), (1, 0.0, 0.0),
    ]


def test_majority_tie_goes_to_the_smaller_label(spark):
    counts = spark.createDataFrame(
        [(0, 0.0, 1, 5), (0, 1.0, 3, 5)], "fold_id int, label double, n_test long, n_train long"
    )
    assert evaluation.majority_baseline(counts).first().majority_label == 0.0


def test_per_class_guards_zero_denominators(spark):
    counts = spark.createDataFrame([(0, 0.0, 0.0, 3), (1, 1.0, 0.0, 2)], COUNTS)
    rows = [tuple(r) for r in evaluation.per_class(counts, NAMES).collect()]
    assert rows == [(0.0, "Estable", 3, 0.6, 1.0, 0.7499999999999999), (1.0, "Top", 2, 0.0, 0.0, 0.0)]


def scores(spark, n=2000, distinct=37):
    i = F.col("id")
    return spark.range(n, numPartitions=8).select(
        i.cast("string").alias("id"),
        (i % 3).cast("int").alias("fold_id"),
        F.when((i * 7919) % 11 < 4, 1.0).otherwise(0.0).alias("label"),
        (((i * 104729) % distinct) / distinct + F.when((i * 7919) % 11 < 4, 0.1).otherwise(0.0))
        .alias("score"),
    )


def brute_auc(rows):
    wins = pairs = 0
    positives = [s for y, s in rows if y == 1]
    negatives = [s for y, s in rows if y != 1]
    for p in positives:
        for n in negatives:
            wins += 1 if p > n else 0.5 if p == n else 0
            pairs += 1
    return wins / pairs


@pytest.mark.parametrize("bins", [2, 16, 256])
def test_area_equals_the_share_of_ordered_pairs(spark, bins):
    df = scores(spark).cache()
    areas = roc.roc_auc(roc.running_counts(roc.score_counts(df), bins)).collect()
    for r in areas:
        rows = df.filter(F.col("fold_id") == r.fold_id).select("label", "score").collect()
        assert math.isclose(r.auc_roc, brute_auc(rows), rel_tol=1e-12)


@pytest.mark.parametrize("bins", [2, 16])
def test_points_rise_to_one_whatever_the_bins(spark, bins):
    df = scores(spark, distinct=501)
    points = roc.roc_points(roc.running_counts(roc.score_counts(df), bins))
    rows = sorted(points.filter("fold_id = 1").collect(), key=lambda r: -r.score)
    assert (rows[0].tpr, rows[0].fpr, rows[0].score) == (0.0, 0.0, math.inf)
    assert (rows[-1].tpr, rows[-1].fpr) == (1.0, 1.0)
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(rows, rows[1:]))
    tp = fp = 0
    counted = sorted(roc.score_counts(df).filter("fold_id = 1").collect(), key=lambda r: -r.score)
    for count, point in zip(counted, rows[1:], strict=True):
        tp, fp = tp + count.pos, fp + count.neg
        assert (point.tp, point.fp) == (tp, fp)


def test_equal_scores_give_one_half(spark):
    df = scores(spark).withColumn("score", F.lit(0.3))
    running = roc.running_counts(roc.score_counts(df))
    assert {r.auc_roc for r in roc.roc_auc(running).collect()} == {0.5}


def test_fold_with_one_class_has_no_area(spark):
    df = scores(spark).withColumn("label", F.lit(1.0))
    running = roc.running_counts(roc.score_counts(df))
    assert {r.auc_roc for r in roc.roc_auc(running).collect()} == {None}
    assert {r.fpr for r in roc.roc_points(running).collect()} == {0.0}


def test_metrics_equal_the_library_evaluators(spark):
    from pyspark.ml.functions import array_to_vector

    df = scores(spark).filter("fold_id = 0").withColumn(
        "prediction", F.when(F.col("score") > 0.6, 1.0).otherwise(0.0)
    )
    raw = array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    library = forest.evaluate(df.withColumn("rawPrediction", raw))
    ours = evaluation.fold_metrics(evaluation.confusion(df)).first()
    for name in ("accuracy", "f1_weighted", "precision_weighted", "recall_weighted"):
        assert math.isclose(ours[name], library[name], rel_tol=1e-12)
    area = roc.roc_auc(roc.running_counts(roc.score_counts(df))).first().auc_roc
    assert math.isclose(area, library["auc_roc"], abs_tol=1e-4)


def test_feature_guards():
    forest.check_features()
    with pytest.raises(ValueError, match="must not be a predictor"):
        forest.check_features(["rank", "days_on_chart"])
    with pytest.raises(ValueError, match="predictors must be"):
        forest.check_features(["days_on_chart"])


def test_default_weight_is_one(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "label double")
    weighted = forest.with_weights(df, {0.0: 0.5, 1.0: 2.0}).collect()
    assert [r.weight for r in weighted] == [0.5, 2.0, 1.0]


def test_positive_label():
    assert forest.positive_label({0.0: "a", 1.0: "b", 2.0: "c"}) == 1.0
    assert forest.positive_label({0.0: "a"}) == 0.0


def test_best_count_prefers_fewer_clusters_on_ties(spark):
    df = spark.createDataFrame(
        [(2, 9.0, 0.4), (3, 8.0, 0.5), (4, 7.0, 0.5)], "k int, inertia double, silhouette double"
    )
    assert segments.best_count(df) == 3


def test_model_summary(spark):
    metrics = spark.createDataFrame(FOLD_METRICS, METRIC_SCHEMA)
    table = report.model_summary(
        evaluation.metrics_summary(metrics), evaluation.best_fold(metrics)
    )
    assert {r["item"]: r.value for r in table.collect()} == {
        "best_fold": "3",
        "auc_roc_mean": "0.7881",
        "auc_roc_std": "0.0024",
        "f1_weighted_mean": "0.7506",
        "f1_weighted_std": "0.0038",
    }
