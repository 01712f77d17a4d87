"""Connected components of a link table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import store

MOST_ROUNDS = 60


def _toward(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: neighbours of each node are linked with the smallest of them and itself.

    ``edges`` has ``a > b``. The large step moves a node's larger neighbours, the small step the node
    itself and its smaller ones.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = store(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        # the rows (a, b) with b > a are the turned edges
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        moved = turned.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        lowest = store(edges.groupBy("a").agg(F.min("b").alias("m")))
        moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(lowest.select("a", F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, component): the smallest node reachable; nodes without links are absent.

    Alternates large and small star steps, each a grouped minimum and a join, until the edges are
    stars. Every round is stored, so a lost executor repeats one round at most. Direction, repeats,
    loops and NULL ends of links do not matter.
    """
    edges = store(
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(MOST_ROUNDS):
        roots = edges.select(F.col("b").alias("r"))
        # stars: no node is both a centre and a leaf, and each leaf has one centre
        chained = edges.select(F.col("a").alias("r")).join(roots, "r", "left_semi").limit(1).count()
        if not chained and not edges.groupBy("a").count().filter("count > 1").limit(1).count():
            break
        edges = store(_toward(_toward(edges, True), False))
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    centres = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))
    )
