"""A forest as a table of nodes, and rows scored by walking it with joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankscope.sources.stored import shared_folder, stored

NODES = "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, votes array<double>"
#: nodes that a step broadcasts, after they were counted
BROADCAST_NODES = 1_000_000


def node_table(spark: SparkSession, model: RandomForestClassificationModel, name: str) -> DataFrame:
    """The nodes of a fitted forest, in the columns of ``NODES``, read from the model's saved form.

    A leaf has no feature. An inner node sends a row left if its value is at most ``threshold``, or one of
    ``categories`` where the feature is a category. ``votes`` has the weight of each class in the node.
    """
    folder = f"{shared_folder(spark)}/{name}"
    model.write().overwrite().save(folder)
    saved = spark.read.parquet(f"{folder}/data")
    node = {f.name: F.col(f"nodeData.{f.name}") for f in saved.schema["nodeData"].dataType}
    inner = node["leftChild"] >= 0
    split = F.col("nodeData.split")
    by_value = split["numCategories"] < 0
    return stored(
        saved.select(
            F.col("treeID").alias("tree"),
            node["id"].alias("node"),
            F.when(inner, split["featureIndex"]).alias("feature"),
            F.when(inner & by_value, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
            F.when(inner & ~by_value, split["leftCategoriesOrThreshold"]).alias("categories"),
            F.when(inner, node["leftChild"]).alias("left"),
            F.when(inner, node["rightChild"]).alias("right"),
            node["impurityStats"].alias("votes"),
        )
    )


def score_trees(rows: DataFrame, nodes: DataFrame, key: str, features: Column, classes: int) -> DataFrame:
    """``(key, score_0 .. score_<classes - 1>, prediction)``: the mean of the trees' class shares per row.

    ``features`` is an array of doubles. Each step of the walk is one join with the nodes, as many as the
    deepest tree has levels; a row is at one node of each tree. ``key`` must be unique. Equal shares go
    to the lower class.
    """
    held = stored(nodes)
    shape = held.agg(F.count("*").alias("nodes"), F.count_distinct("tree").alias("trees")).first()
    trees = shape["trees"]
    table = F.broadcast(held) if shape["nodes"] <= BROADCAST_NODES else held
    roots = [r["tree"] for r in held.select("tree").distinct().collect()]
    at = rows.select(F.col(key), features.alias("__x"), F.explode(F.array(*[F.lit(t) for t in sorted(roots)])).alias("tree"))
    at = at.withColumn("node", F.lit(0))
    for _ in range(depth(held)):
        value = F.get("__x", F.col("feature"))
        goes_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
        step = F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(table, ["tree", "node"]).select(key, "__x", "tree", step.alias("node"))
    leaf = at.join(table, ["tree", "node"])
    total = F.aggregate("votes", F.lit(0.0), lambda a, b: a + b)
    shares = [F.sum(F.try_divide(F.get("votes", F.lit(k)), total)).alias(f"score_{k}") for k in range(classes)]
    scored = leaf.groupBy(key).agg(*shares)
    scored = scored.withColumns({f"score_{k}": F.col(f"score_{k}") / trees for k in range(classes)})
    best = F.greatest(*[F.struct(F.col(f"score_{k}").alias("s"), F.lit(-k).alias("k")) for k in range(classes)])
    return scored.withColumn("prediction", (-best["k"]).cast("double"))


def depth(nodes: DataFrame) -> int:
    """Steps from a root to the deepest leaf; the driver gets the pairs of parent and child of inner nodes."""
    children: dict[tuple[int, int], list[int]] = {}
    for r in nodes.filter(F.col("feature").isNotNull()).select("tree", "node", "left", "right").collect():
        children[r["tree"], r["node"]] = [r["left"], r["right"]]
    level = [(tree, 0) for tree in {tree for tree, _ in children}]
    steps = 0
    while level:
        level = [(tree, child) for tree, node in level for child in children.get((tree, node), [])]
        steps += bool(level)
    return steps


def fixed_nodes(spark: SparkSession, trees: Mapping[int, Sequence[tuple]]) -> DataFrame:
    """Nodes written down as ``(node, feature, threshold, left, right, votes)`` per tree."""
    rows = [
        (tree, node, feature, threshold, None, left, right, [float(x) for x in votes])
        for tree, nodes in trees.items()
        for node, feature, threshold, left, right, votes in nodes
    ]
    return spark.createDataFrame(rows, NODES)
