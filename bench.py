"""Seconds per registered query; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default all), ``BENCH_QUERIES`` (comma
separated, default all that do not repeat another's fit). Each query is planned and run in full to a sink that discards
rows. The first query is run once beforehand, so that no figure holds the start of the engine.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rankscope.plans.queries import QUERIES
from rankscope.session import build_session

#: queries that repeat the fit of forest_cv or kmeans_sweep for another table of it
SAME_FIT = {
    "forest_vs_baseline", "importance", "clusters", "cluster_composition", "cluster_totals",
    "cluster_strata",
}
HEADLINE = tuple(name for name in QUERIES if name not in SAME_FIT)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = os.environ.get("BENCH_QUERIES", "")
    selected = names.split(",") if names else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, selected[0], sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in selected}
    print(
        json.dumps(
            {
                "metric": "registered queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
