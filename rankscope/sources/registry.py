"""Which of the expected files are there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rankscope import vocabulary as v

STATUS_SCHEMA = "table_name string, file_name string, file_path string, present boolean"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whatever file system its scheme names."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).exists(hadoop_path)


def file_status(
    spark: SparkSession, folder: str, files: Mapping[str, str] = v.RAW_FILES
) -> DataFrame:
    """One row per expected table: its path and whether it is present."""
    rows = []
    for table, file_name in files.items():
        path = f"{folder.rstrip('/')}/{file_name}"
        rows.append((table, file_name, path, path_exists(spark, path)))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def present_files(status: DataFrame) -> dict[str, str]:
    """Table name to path of the files that are there."""
    return {r.table_name: r.file_path for r in status.filter("present").collect()}


def require_files(status: DataFrame, *tables: str) -> DataFrame:
    """The status of the named tables (all by default); raises if one of them is missing."""
    wanted = status.filter(status.table_name.isin(*tables)) if tables else status
    rows = wanted.collect()
    missing = [r.file_path for r in rows if not r.present]
    missing += sorted(set(tables) - {r.table_name for r in rows})
    if missing:
        raise FileNotFoundError(f"missing input: {', '.join(missing)}")
    return wanted
