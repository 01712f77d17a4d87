"""Clusters of given centres and forests as tables, against the library's own models."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankscope.operators import segments, trees


def points(spark):
    n = F.col("id")
    return spark.range(600).select(
        n.alias("key"),
        (F.pmod(F.hash(n), F.lit(100)) / 10 + F.when(n % 3 == 0, 12).otherwise(0)).alias("x"),
        (F.pmod(F.hash(n, n), F.lit(70)) / 10 - F.when(n % 3 == 1, 9).otherwise(0)).alias("y"),
    )


def test_clusters_of_a_fit_have_its_sizes_cost_and_silhouette(spark):
    columns = ["x", "y"]
    rows = VectorAssembler(inputCols=columns, outputCol=segments.SCALED).transform(points(spark)).cache()
    model = segments.fit_clusters(rows, 3, 40)
    fitted = model.transform(rows)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    assigned = segments.assign(points(spark), centres, columns)
    both = assigned.join(fitted.select("key", F.col("prediction").alias("theirs")), "key")
    assert both.filter("prediction <> theirs").count() == 0
    profile = segments.profile_clusters(points(spark), centres, columns, columns)
    sizes = {r.prediction: r["count"] for r in fitted.groupBy("prediction").count().collect()}
    assert {r.prediction: r["count"] for r in profile.collect()} == sizes
    score = segments.score_clusters(profile).first()
    assert score.k == 3 and math.isclose(score.inertia, model.summary.trainingCost, rel_tol=1e-9)
    assert math.isclose(score.silhouette, segments.silhouette(fitted), rel_tol=1e-9)
    for r in profile.collect():
        assert math.isclose(r.x, centres[r.prediction][0], abs_tol=1e-6)
    assert math.isclose(sum(r.pct for r in profile.collect()), 100)


def test_lone_rows_ties_missing_values_and_one_cluster(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (9.0, 9.0), (None, 1.0), (4.5, 4.5)], "x double, y double")
    assigned = segments.assign(df, [(0.0, 0.0), (9.0, 9.0)], ["x", "y"])
    assert [r.prediction for r in assigned.collect()] == [0, 0, 1, None, 0]
    profile = {r.prediction: r for r in segments.profile_clusters(df, [(0.0, 0.0), (9.0, 9.0)], ["x", "y"]).collect()}
    assert profile[1]["count"] == 1 and profile[1].silhouette == 0.0
    one = segments.profile_clusters(df, [(0.0, 0.0)], ["x", "y"]).first()
    assert one["count"] == 4 and one.silhouette is None
    assert segments.profile_clusters(df.limit(0), [(0.0, 0.0), (1.0, 1.0)], ["x", "y"]).count() == 0


@pytest.mark.parametrize("depth", [1, 4])
def test_node_table_scores_like_the_model(spark, depth):
    rows = points(spark).withColumns({
        "kind": F.concat(F.lit("k"), (F.col("key") % 6).cast("string")),
        "label": ((F.col("x") + F.col("y") > 6) | (F.col("key") % 6 == 2)).cast("double"),
    })
    indexed = StringIndexer(inputCol="kind", outputCol="kind_idx").fit(rows).transform(rows)
    data = VectorAssembler(inputCols=["x", "y", "kind_idx"], outputCol="features").transform(indexed).cache()
    model = RandomForestClassifier(numTrees=5, maxDepth=depth, seed=3).fit(data)
    nodes = trees.node_table(spark, model, f"forest-test-{depth}")
    assert nodes.filter("categories is not null").count() > 0 and trees.depth(nodes) <= depth
    ours = trees.score_trees(data, nodes, "key", vector_to_array("features"), 2)
    theirs = model.transform(data).select("key", vector_to_array("probability").alias("p"), F.col("prediction").alias("theirs"))
    both = ours.join(theirs, "key")
    assert both.count() == 600
    assert both.filter("abs(score_1 - p[1]) > 1e-9 or abs(score_0 - p[0]) > 1e-9 or prediction <> theirs").count() == 0


def test_a_single_leaf_is_a_forest(spark):
    nodes = trees.fixed_nodes(spark, {4: [(0, None, None, None, None, (1, 3))]})
    row = trees.score_trees(points(spark).limit(1), nodes, "key", F.array("x"), 2).first()
    assert (row.score_0, row.score_1, row.prediction) == (0.25, 0.75, 1.0)
