"""Helpers of the text operators: stored intermediates, reading, runs of rows inside one task."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress
from functools import lru_cache
from itertools import pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: how the names of stored tables begin
STORED = "rankscope-llm-"
#: Spark's own setting, by which the shuffle files of a query are removed when it ends
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rankscope-")


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the folder in ``spark.checkpoint.dir`` and read it back.

    Later steps read the files, so a lost executor costs none of the work before this point. A grouped
    table that is stored before it joins the rows of its keys also lets adaptive execution split the
    join of a hot key, which it does not do where a side is still partitioned by the grouping. Where
    that setting is absent a temporary folder of this machine is taken in a local session, as in tests; on a
    cluster that raises, since other machines could not read it. The shuffle files of the write go at its
    end, as nothing reads them any more.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master or 'the cluster'} share")
        folder = _local_folder()
    path = f"{folder.rstrip('/')}/{STORED}{uuid4()}"
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Deletes the files of a table that ``store`` made and that nothing reads any more."""
    folders = {name.rsplit("/", 1)[0] for name in stored.inputFiles()}
    for folder in folders:
        if not folder.rsplit("/", 1)[-1].startswith(STORED):
            raise ValueError(f"{folder} was not made by store")
        path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, after which the worker gives its free memory back.

    A worker outlives its task. What an earlier operator freed stays with the allocators, and operators that
    follow each other in one application would add up to more than any of them needs.
    """

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # a C library without it keeps the pages
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def hex_number(text: Column, first: int, digits: int) -> Column:
    """``digits`` (15 at most) hex digits of ``text`` from position ``first`` as a number."""
    return F.conv(F.substring(text, first, digits), 16, 10).cast("long")


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, NULL as the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def cut(batches: Batches, name: str, size: int) -> Batches:
    """The batches in stretches of about ``size`` bytes of their text column, one row at least.

    A batch may hold ten thousand long texts. What is made of a stretch is handed on before the next is begun, so
    a worker and the executor that reads its results hold one stretch of strings and results, not a whole batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (np.cumsum(sizes) - sizes) // size
        starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist()
        for start, end in pairwise([*starts, batch.num_rows]):
            yield batch.slice(start, end - start)


def slices(texts: list[str | None], chars: int) -> Iterator[slice]:
    """Consecutive slices of about ``chars`` characters, one text at least."""
    start = total = 0
    for i, text in enumerate(texts):
        if total >= chars:
            yield slice(start, i)
            start, total = i, 0
        total += len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, one table each; the input is sorted by them.

    Holds one run and one batch. The caller bounds the length of a run.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i, value in enumerate(values):
            if value != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, current, start = [], value, i
        if len(values) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
