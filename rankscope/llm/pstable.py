"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised. Each of several tables adds a random offset to Gaussian projections, quantises
them by a width and hashes the numbers to a bucket. Vectors that share a bucket in some table are
compared exactly. How many projections a table has follows from the number of vectors (so that strangers
rarely meet), how many tables from the recall wanted for a pair exactly at the threshold.

Equal vectors are one class that is hashed once. A large bucket is cut into blocks, and each pair of
blocks is compared in a task of its own, so no bucket is gathered and none is skipped. A pair counts
only in the first table in which it meets. NULL, empty and zero vectors and those with a NULL or
non-finite component link with nothing, nor do vectors of different length. Repeated ids are
separate vectors with equal id: they count as one another's links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import runs, store
from rankscope.llm.components import components

WIDTH = 2.0
BLOCK = 512


def meeting_chance(distance: float, width: float) -> float:
    """Chance that one quantised Gaussian projection puts two points at ``distance`` together."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


@dataclass(frozen=True)
class Plan:
    tables: int
    projections: int
    seed: int

    @staticmethod
    def of(count: int, cosine: float, recall: float, seed: int = 11) -> Plan:
        """Strangers (at a right angle) meet about once a table for each vector at most."""
        near = meeting_chance(math.sqrt(2 - 2 * cosine), WIDTH)
        far = meeting_chance(math.sqrt(2), WIDTH)
        projections = max(2, math.ceil(math.log(max(2, count)) / -math.log(far)))
        tables = math.ceil(math.log(1 - recall) / math.log(1 - near**projections))
        return Plan(tables, projections, seed)


def hash_vectors(vectors: np.ndarray, plan: Plan) -> np.ndarray:
    """Bucket numbers, a column for each table."""
    rng = np.random.default_rng([plan.seed, vectors.shape[1]])
    lines = rng.normal(size=(vectors.shape[1], plan.tables * plan.projections))
    offsets = rng.uniform(0, WIDTH, plan.tables * plan.projections)
    cells = np.floor((vectors @ lines + offsets) / WIDTH).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(vectors), plan.tables, plan.projections)
    mixed = np.full(cells.shape[:2], vectors.shape[1], np.uint64)
    for k in range(plan.projections):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + cells[:, :, k]
    return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)).astype(np.int64)


def _bucketed(classes: DataFrame, plan: Plan) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size"))
            ids, weights, values = batch.column("id"), batch.column("weight"), batch.column("vector")
            for size in np.unique(sizes):
                rows = pa.array(np.nonzero(sizes == size)[0])
                flat = np.array(values.take(rows).flatten(), np.float64).reshape(-1, size)
                unit = flat / np.abs(flat).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                buckets = hash_vectors(unit, plan)
                bounds = lambda n: pa.array(np.arange(len(flat) + 1) * n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows),
                        weights.take(rows),
                        pa.ListArray.from_arrays(bounds(size), pa.array(unit.ravel())),
                        pa.ListArray.from_arrays(bounds(plan.tables), pa.array(buckets.ravel())),
                    ],
                    ["id", "weight", "unit", "buckets"],
                )

    return classes.mapInArrow(run, "id long, weight long, unit array<double>, buckets array<long>")


def _compare(cells: DataFrame, cosine: float) -> DataFrame:
    """(kind, a, b): for each row of a cell how many it links with, and a spanning set of links."""

    def matrix(column: pa.ChunkedArray, n: int, kind: type) -> np.ndarray:
        return np.array(column.combine_chunks().flatten(), kind).reshape(n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["t", "bucket", "i", "j"]):
            n = cell.num_rows
            ids, weights = np.array(cell["id"]), np.array(cell["weight"])
            sizes = np.array([len(x) for x in cell["unit"]])
            if len(set(sizes.tolist())) != 1:
                continue  # a hash shared by lengths, which never link
            t, i, j = cell["t"][0].as_py(), cell["i"][0].as_py(), cell["j"][0].as_py()
            unit, buckets = matrix(cell["unit"], n, np.float64), matrix(cell["buckets"], n, np.int64)
            block = np.array(cell["block"])
            a = np.nonzero(block == i)[0]
            b = a if i == j else np.nonzero(block == j)[0]
            left, right = np.nonzero(unit[a] @ unit[b].T >= cosine)
            left, right = a[left], b[right]
            keep = ids[left] < ids[right] if i == j else np.ones(len(left), bool)
            left, right = left[keep], right[keep]
            first = np.ones(len(left), bool)
            for earlier in range(t):
                first &= buckets[left, earlier] != buckets[right, earlier]
            left, right = left[first], right[first]
            if not len(left):
                continue
            counts = np.zeros(n, np.int64)
            np.add.at(counts, left, weights[right])
            np.add.at(counts, right, weights[left])
            linked = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(linked), np.int32)), pa.array(ids[linked]), pa.array(counts[linked])],
                ["kind", "a", "b"],
            )
            roots = np.arange(n)
            kept = []
            for x, y in zip(left.tolist(), right.tolist(), strict=True):
                while roots[x] != x:
                    roots[x] = x = roots[roots[x]]
                while roots[y] != y:
                    roots[y] = y = roots[roots[y]]
                if x != y:
                    roots[y] = x
                    kept.append((x, y))
            x, y = np.array(kept).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(kept), np.int32)), pa.array(ids[x]), pa.array(ids[y])], ["kind", "a", "b"]
            )

    return cells.mapInArrow(run, "kind int, a long, b long")


def near_vectors(
    rows: DataFrame, cosine: float = 0.95, recall: float = 0.98, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per row of ``rows``: key, ``n_links``, ``component_id``, ``kept``."""
    source = rows.select(rows[key].cast("long").alias("id"), rows[vector].cast("array<double>").alias("vector"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("vector", lambda x: x != 0)
    usable = (F.size("vector") > 0) & finite & F.col("id").isNotNull()
    # -0.0 and 0.0 are the same component
    whole = F.transform("vector", lambda x: x + F.lit(0.0))
    coded = source.select("id", F.when(usable, whole).alias("vector")).withColumn(
        "mark", F.when(F.col("vector").isNotNull(), F.sha2(F.to_json(F.struct("vector")), 256))
    )
    coded = store(coded)
    members = coded.select("id", "mark")
    classes = coded.filter("mark is not null").groupBy("mark").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.any_value("vector").alias("vector")
    )
    # one id can stand for several classes: number them by their mark instead
    classes = classes.withColumn("class", F.xxhash64("mark"))
    heads = store(classes.select("class", "mark", F.col("id").alias("least"), "weight", "vector"))
    plan = Plan.of(heads.count(), cosine, recall)
    sized = heads.select(F.col("class").alias("id"), "weight", "vector", F.size("vector").alias("size"))
    hashed = store(_bucketed(sized, plan))
    met = hashed.select("id", F.posexplode("buckets").alias("t", "bucket"))
    full = met.groupBy("t", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    full = full.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    full = store(full.drop("n"))
    placed = met.join(full, ["t", "bucket"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = placed.select("id", "t", "bucket", "block", other)
    paired = paired.select(
        "id", "t", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    cells = paired.join(hashed, "id").repartition("t", "bucket", "i", "j")
    cells = cells.sortWithinPartitions("t", "bucket", "i", "j")
    found = store(_compare(cells, cosine))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("others"))
    links = found.filter("kind = 1").select("a", "b")
    reached = components(links).select(F.col("node").alias("class"), "component")
    grouped = heads.select("class", "mark", "least", "weight").join(reached, "class", "left").join(counts, "class", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "class"))
    lowest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = grouped.join(lowest, "component").select("mark", "weight", "others", "component_id")
    joined = members.join(store(answers), "mark", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce(F.col("weight") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
