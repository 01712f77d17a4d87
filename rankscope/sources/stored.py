"""Intermediate tables that are written once and read many times.

They go to the folder in ``spark.checkpoint.dir``, which all machines share. What is read back has no lineage
beyond its files: a lost executor costs no work before this point, a plan that uses the table twice scans
files twice instead of evaluating everything below, and the size of the files is known to the planner.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Mapping, Sequence
from functools import lru_cache
from threading import Lock
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

#: (application, name, state of the inputs) to the tables made of them
_made: dict[tuple, dict[str, DataFrame]] = {}
_lock = Lock()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rankscope-")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediates; one of this machine only where the session runs on this machine alone."""
    folder = spark.conf.get(SETTING, "") or ""
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SETTING} to a folder that all machines of {master or 'the cluster'} share")
    return _local_folder()


def stored(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet and read back.

    With ``keys``, rows of a key lie together: the rebalance hint makes even files and splits a key that
    would fill too large a one, and sorted rows let a filter on the key skip row groups.
    """
    path = f"{shared_folder(df.sparkSession)}/rankscope-{uuid4()}"
    if keys:
        df = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def state_of(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Name, size and time of every file under ``paths``; file contents are not read."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
    return tuple(sorted(map(tuple, files.collect())))


def tables_once(
    spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], Mapping[str, DataFrame]]
) -> dict[str, DataFrame]:
    """The tables that ``build`` makes of the ``inputs``, stored at the first call of this application.

    Later calls with the same ``name`` read them back. Changed input files, or tables that were deleted
    meanwhile, lead to a new build. ``name`` must tell different settings apart.
    """
    key = (spark.sparkContext.applicationId, name, state_of(spark, inputs))
    with _lock:
        made = _made.get(key)
    if made and all(_readable(df) for df in made.values()):
        return dict(made)
    made = {table: stored(df) for table, df in build().items()}
    with _lock:
        _made[key] = made
    return dict(made)


def stored_once(
    spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame], keys: Sequence[str] = ()
) -> DataFrame:
    """``tables_once`` for one table, laid out by ``keys`` if given."""
    key = (spark.sparkContext.applicationId, name, state_of(spark, inputs))
    with _lock:
        made = _made.get(key, {}).get(name)
    if made is None or not _readable(made):
        made = stored(build(), keys)
        with _lock:
            _made[key] = {name: made}
    return made


def _readable(df: DataFrame) -> bool:
    try:
        df.sparkSession.read.schema(df.schema).parquet(*_folders(df))
    except AnalysisException:
        return False
    return True


def _folders(df: DataFrame) -> list[str]:
    return sorted({file.rsplit("/", 1)[0] for file in df.inputFiles()})
