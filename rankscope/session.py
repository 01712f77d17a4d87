"""Session settings, ways of keeping an intermediate result, and jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "rankscope", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist ``df`` for the block. The lineage stays, so a lost executor is recomputed."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def side_by_side(
    spark: SparkSession,
    function: Callable[[Item], Result],
    items: Iterable[Item],
    workers: int = 4,
) -> list[Result]:
    """``function`` of each item, a few at a time, results in order.

    For a handful of independent fits on one persisted table: a single fit on a sample leaves most
    executors idle.
    """
    with ThreadPool(workers) as pool:
        return pool.map(inheritable_thread_target(spark)(function), items, chunksize=1)
