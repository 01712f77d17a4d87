"""Writing tables and reading result tables back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankscope.functions.banding import all_strata

# Column types of the result tables, for reading them back without inference.
_SCORES = (
    "accuracy double, f1_weighted double, precision_weighted double, "
    "recall_weighted double, auc_roc double"
)
RESULT_SCHEMAS = {
    "strata": "partition_id string, count_P long, prop_P double, count_M long, prop_M double, "
    "abs_diff_pct double",
    "folds": "fold_id int, count long, pct_M double",
    "tuning": f"numTrees int, maxDepth int, {_SCORES}",
    "fold_metrics": f"{_SCORES}, fold_id int, n_train long, n_test long, class_weight string",
    "baseline_folds": f"{_SCORES}, fold_id int, majority_label double",
    "model_vs_baseline": "metric string, mean double, std double, min double, max double, "
    "baseline_mean double, baseline_std double, delta_model_minus_baseline double",
    "per_class": "label double, class string, support long, precision double, recall double, "
    "f1 double",
    "summary": "metric string, mean double, std double, min double, max double",
    "confusion": "class string, Estable long, Top long",
    "importance": "feature string, mean double, std double",
    "kmeans": "k int, inertia double, silhouette double",
    "cluster_sizes": "prediction int, count long, pct double",
    "centroids": "cluster int, days_on_chart double, max_days_on_chart double, "
    "country_count_by_artist double, rank double, count long, pct double",
    "cluster_composition": "prediction int, " + ", ".join(f"`{s}` double" for s in all_strata()),
}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def land_chart(chart: DataFrame, path: str, date: str = "fecha") -> None:
    """Write a typed chart once as parquet, one folder per month.

    The rebalance hint lets adaptive execution make evenly sized files: it splits a month that
    holds too much, joins small ones, and spreads the single split of a gzip file.
    """
    monthly = chart.withColumn("month", F.date_format(date, "yyyy-MM"))
    write_parquet(monthly.hint("rebalance", "month"), path, ["month"])


def write_text_csv(df: DataFrame, path: str, gzip: bool = True) -> None:
    """A table of any size as CSV files with headers, as raw tables come; text is kept to the space.

    Each file is written by a task of its own. Gzip files cannot be split by a later reader, so there are many.
    """
    writer = df.write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none")
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. Only for result tables, which hold tens of rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_table_csv(df, f"{folder.rstrip('/')}/{name}")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result table with its column types. Columns are found by name, in whatever order."""
    text = spark.read.option("header", True).csv(f"{folder.rstrip('/')}/{name}")
    columns = StructType.fromDDL(RESULT_SCHEMAS[name])
    return text.select(*[F.col(f"`{c.name}`").cast(c.dataType) for c in columns])


def write_document(df: DataFrame, path: str) -> None:
    """A one-row nested table as one JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)
