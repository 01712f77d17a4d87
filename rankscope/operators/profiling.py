"""Table profiles. Every function reads its table once, however many columns it has."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, NumericType

from rankscope.functions.aggregates import distinct_rows, guarded_percent, null_count
from rankscope.functions.parsing import malformed
from rankscope.operators.quantiles import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    """Integer and floating columns; bytes and decimals do not count as numeric here."""
    excluded = (ByteType, DecimalType)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, excluded)
    ]


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable, and the non-NULL values it holds."""
    entries = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.count(F.col(f"`{f.name}`")).alias("value_count"),
        )
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the NULL count of each column."""
    return df.agg(*[null_count(f"`{c}`").alias(c) for c in columns or df.columns])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percent per column, most NULLs first; percent is NULL for an empty table."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            null_count(f"`{c}`").alias("null_count"),
            F.count("*").alias("rows"),
        )
        for c in columns or df.columns
    ]
    counts = df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
    percent = guarded_percent(F.col("null_count"), F.col("rows"), 4)
    return (
        counts.withColumn("null_pct", percent)
        .drop("rows")
        .orderBy(F.desc("null_count"), "column_name")
    )


def numeric_summary(
    df: DataFrame, quartiles: bool = True, accuracy: int = 10_000
) -> DataFrame | None:
    """Count, mean, sample deviation, bounds and quartiles per numeric column, typed and long.

    Quartiles are bounded sketches, as in the built-in summary. None if no column is numeric.
    """
    columns = numeric_columns(df)
    if not columns:
        return None

    def entry(name: str) -> Column:
        c = F.col(f"`{name}`").cast("double")
        fields = [
            F.lit(name).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).alias("min"),
        ]
        if quartiles:
            cuts = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
            fields += [F.get(cuts, F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
        return F.struct(*fields, F.max(c).alias("max"))

    entries = df.agg(F.array(*[entry(c) for c in columns]).alias("entries"))
    return entries.select(F.inline("entries"))


def exact_quartiles(df: DataFrame) -> DataFrame:
    """The smallest value of each numeric column that a quarter, half and three quarters reach.

    One pass counts the values of all columns; no task sorts a whole column. NULL and NaN are left out.
    """
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value"))
        for c in numeric_columns(df)
    ]
    values = df.select(F.inline(F.array(*pairs)))
    return exact_quantiles(values, ["column_name"], "value").drop("count")


def table_summary(
    df: DataFrame, table_name: str, file_name: str = "", file_path: str = ""
) -> DataFrame:
    """One row: where the table came from, its rows and its number of columns."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(file_name).alias("file_name"),
        F.lit(file_path).alias("file_path"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
    )


def union_tables(tables: Iterable[DataFrame]) -> DataFrame:
    """Stack tables by column name."""
    return reduce(DataFrame.unionByName, tables)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return repeated.agg(F.count("*").alias("duplicate_count"))


def coverage(chart: DataFrame, name: str, market: str = "pais", date: str = "fecha") -> DataFrame:
    """One row: rows, markets (a NULL market counts as one) and first and last date."""
    return chart.agg(
        F.count("*").alias("filas"),
        distinct_rows(market).alias("paises"),
        F.min(date).alias("fecha_min"),
        F.max(date).alias("fecha_max"),
    ).select(F.lit(name).alias("dataset"), "filas", "paises", "fecha_min", "fecha_max")


def count_checks(df: DataFrame, name: str, checks: Mapping[str, Column]) -> DataFrame:
    """One row: in how many rows each condition holds."""
    counts = df.agg(*[F.count_if(check).alias(label) for label, check in checks.items()])
    return counts.select(F.lit(name).alias("tabla"), *checks)


def artist_quality(chart: DataFrame) -> DataFrame:
    checks = {
        "filas_rank_invalido": F.col("rank").isNull(),
        "filas_fecha_invalida": F.col("fecha").isNull(),
        "filas_days_on_chart_invalido": F.col("days_on_chart").isNull(),
    }
    return count_checks(chart, "artistas", checks)


def album_quality(chart: DataFrame) -> DataFrame:
    checks = {
        "filas_rank_invalido": F.col("rank").isNull(),
        "filas_release_date_malformada": malformed("release_date_raw", "release_date"),
        "filas_entry_rank_malformado": malformed("entry_rank_raw", "entry_rank"),
    }
    return count_checks(chart, "albumes", checks)


def quality_report(artists: DataFrame, albums: DataFrame) -> DataFrame:
    """Both quality rows; a check that a table does not have is NULL."""
    return artist_quality(artists).unionByName(album_quality(albums), allowMissingColumns=True)


def population_audit(
    raw: DataFrame,
    keys: Sequence[str] = ("date", "country", "rank", "artist_uri", "days_on_chart"),
    date: str = "date",
) -> DataFrame:
    """One row: rows, date bounds, NULLs per key column and repeated key groups.

    The grouping that finds repeated keys also carries the other counts, so the table is read and
    shuffled once.
    """
    groups = raw.groupBy(*keys).agg(F.count("*").alias("__n"))

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("__n"))), F.lit(0))

    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_original"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        *[rows_where(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
        F.count_if(F.col("__n") > 1).alias("duplicate_count"),
    )
