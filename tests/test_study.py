"""The whole cohort study on a small chart: fitted models by tolerance and invariants."""

from __future__ import annotations

import json
import math

import pytest

from rankscope import vocabulary as v
from rankscope.operators import forest, segments
from rankscope.plans import charts
from rankscope.plans.queries import SETTINGS
from rankscope.plans.studies import StudySettings, run_study, study_folds, study_population
from rankscope.plans.studies import study_sample
from rankscope.sources import sinks

SF_DIR = "/root/testdata/sf0.001"
SMALL = StudySettings(
    excluded="NATION_7", start="1996-01-01", veteran_after=2, global_after=8, top_until=8,
    target=1500, folds=3, grid=((4, 3), (6, 4)), cluster_counts=(2, 3),
)


@pytest.fixture(scope="module")
def study(spark):
    return run_study(charts.monthly_chart(spark, SF_DIR), SMALL)


@pytest.fixture(scope="module")
def sample(spark):
    people = study_population(charts.monthly_chart(spark, SF_DIR), SMALL)
    return study_folds(study_sample(people, SMALL), SMALL).cache()


def rows(study, name):
    return study.tables[name].collect()


def test_tables_are_complete(study):
    assert set(study.tables) == set(sinks.RESULT_SCHEMAS) | {"cluster_composition"}
    assert all(df.count() > 0 for df in study.tables.values())


def test_fold_metrics(study):
    metrics = rows(study, "fold_metrics")
    sample_size = sum(r["count"] for r in rows(study, "folds"))
    assert [r.fold_id for r in metrics] == [0, 1, 2]
    for r in metrics:
        assert math.isclose(r.recall_weighted, r.accuracy)
        assert r.n_train + r.n_test == sample_size
        assert all(0 <= r[m] <= 1 for m in v.METRICS)
        assert r.class_weight.startswith("{'0.0': ")
    for r in rows(study, "baseline_folds"):
        assert math.isclose(r.precision_weighted, r.accuracy**2) and r.auc_roc == 0.5


def test_summaries_agree(study):
    mean = {r.metric: r["mean"] for r in rows(study, "model_vs_baseline")}
    for m in v.METRICS:
        values = [r[m] for r in rows(study, "fold_metrics")]
        assert math.isclose(mean[m], sum(values) / 3)
    per_class = rows(study, "per_class")
    assert sum(r.support for r in per_class) == sum(r["count"] for r in rows(study, "folds"))
    confusion = rows(study, "confusion")
    assert [r["class"] for r in confusion] == [r["class"] for r in per_class]
    assert math.isclose(sum(r["mean"] for r in rows(study, "importance")), 1.0)


def test_tuning_order(study):
    tuned = rows(study, "tuning")
    assert [r.auc_roc for r in tuned] == sorted((r.auc_roc for r in tuned), reverse=True)
    assert {(r.numTrees, r.maxDepth) for r in tuned} == {(4, 3), (6, 4)}


def test_clusters(study):
    assert all(-1 <= r.silhouette <= 1 for r in rows(study, "kmeans"))
    sizes = rows(study, "cluster_sizes")
    assert sum(r["count"] for r in sizes) == sum(r["count"] for r in rows(study, "folds"))
    assert math.isclose(sum(r.pct for r in sizes), 100)
    for r in rows(study, "cluster_composition"):
        assert math.isclose(sum(r[1:]), 100)
    centres = rows(study, "centroids")
    assert all(1 <= r.rank <= 200 and r.days_on_chart >= 0 for r in centres)


def test_written_tables_read_back(spark, study, tmp_path):
    study.write(str(tmp_path))
    for name in sinks.RESULT_SCHEMAS:
        back = sinks.read_table(spark, str(tmp_path), name)
        assert back.count() == study.tables[name].count()
        assert back.collect() == study.tables[name].select(back.columns).collect()
    document = json.loads(next((tmp_path / "final_metrics").glob("*.json")).read_text())
    assert list(document) == [
        "dataset", "sample", "folds", "random_forest", "kmeans", "integrity",
    ]
    assert document["integrity"]["rank_excluded_from_supervised_features"] is True
    assert document["integrity"]["five_balanced_folds"] is True
    assert document["sample"]["actual"] == document["sample"]["clean"]
    assert set(document["random_forest"]["metrics_mean"]) == set(v.METRICS)
    read = sinks.read_document(spark, str(tmp_path / "final_metrics")).first()
    assert read.dataset.excluded_country == "NATION_7"


def test_sample_has_its_size(sample):
    assert abs(sample.count() - SMALL.target) <= 8
    assert sample.select("id").distinct().count() == sample.count()


def test_evaluators_and_exact_metrics_agree_on_a_forest(spark, sample):
    features, model = forest.add_features(sample)
    features = features.cache()
    names = forest.label_names(model)
    assert set(names.values()) == {v.TOP, v.STABLE} and forest.positive_label(names) == 1.0
    forest.check_bins(model)
    with pytest.raises(ValueError, match="values for 3 bins"):
        forest.check_bins(model, 3)
    weights = forest.collect_weights(features, 3)[0]
    train = forest.with_weights(features.filter("fold_id <> 0"), weights)
    fitted = forest.fit_forest(train, 4, 3, v.SEED)
    scored = forest.scored(fitted, features.filter("fold_id = 0"), 1.0).cache()
    library = forest.evaluate(scored)
    cv = forest.cross_validate(features, 4, 3, 3)
    ours = cv.metrics.filter("fold_id = 0").first()
    for m in v.METRICS:
        assert math.isclose(ours[m], library[m], abs_tol=1e-3)
    assert cv.predictions.count() == features.count()
    assert cv.predictions.filter("score < 0 or score > 1").count() == 0
    cv.release()


def test_unseen_category_and_unseen_label(spark, sample):
    model = forest.feature_pipeline().fit(sample)
    index = {(r.column_name, r.value): r.index for r in
             forest.category_index(model, spark).collect()}
    countries = [k for k in index if k[0] == "country"]
    from pyspark.sql import functions as F

    strange = sample.limit(1).withColumn("country", F.lit("nowhere"))
    assert model.transform(strange).first().country_idx == len(countries)
    missing = sample.limit(1).withColumn("country", F.lit(None).cast("string"))
    assert model.transform(missing).first().country_idx == len(countries)
    with pytest.raises(Exception, match="Unseen label"):
        model.transform(sample.limit(1).withColumn("rank_tier", F.lit("Other"))).collect()


def test_category_with_too_many_values_is_refused_before_it_is_collected(sample):
    with pytest.raises(ValueError, match="country has about .* values for 128 bins"):
        forest.add_features(sample.withColumn("country", sample.id))


def test_scaled_columns_have_mean_zero_and_deviation_one(sample):
    from pyspark.sql import functions as F

    scaled, _ = segments.scale(sample)
    wide = segments.scaled_columns(scaled, [])
    for c in wide.columns:
        mean, std = wide.agg(F.avg(c), F.stddev_samp(c)).first()
        assert abs(mean) < 1e-9 and math.isclose(std, 1.0)


def test_registered_settings_give_all_strata():
    assert (SETTINGS.target, SETTINGS.folds, SETTINGS.seed) == (5000, 5, 42)
