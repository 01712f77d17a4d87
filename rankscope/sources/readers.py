"""Delimited readers and the typed chart tables made from them.

``.gz`` files need no option: the codec follows from the suffix. A gzip file is one split, so the
landing step in ``sinks`` spreads its rows again before they are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rankscope.functions.parsing import safe_date, safe_int


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, every column a string.

    With ``columns`` the file is read once by position; without, Spark looks at its first line.
    """
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types, one record per line.

    Inference reads the whole file once more; use it for files whose columns are not known.
    """
    reader = spark.read.option("header", True).option("inferSchema", True)
    return reader.option("multiLine", False).csv(path)


Parser = Callable[[str], Column]
#: raw column, typed column, parser
_ARTISTS: tuple[tuple[str, str, Parser], ...] = (
    ("date", "fecha", safe_date),
    ("country", "pais", F.col),
    ("rank", "rank", safe_int),
    ("uri", "artist_uri", F.col),
    ("artist_name", "artist_name", F.col),
    ("peak_rank", "peak_rank", safe_int),
    ("previous_rank", "previous_rank", safe_int),
    ("days_on_chart", "days_on_chart", safe_int),
    ("consecutive_days", "consecutive_days", safe_int),
    ("entry_status", "entry_status", F.col),
    ("entry_rank", "entry_rank", safe_int),
    ("entry_date", "entry_date", safe_date),
)
_ALBUMS: tuple[tuple[str, str, Parser], ...] = (
    ("date", "fecha", safe_date),
    ("country", "pais", F.col),
    ("rank", "rank", safe_int),
    ("uri", "album_uri", F.col),
    ("album_name", "album_name", F.col),
    ("artist_names", "artist_names", F.col),
    ("label", "label", F.col),
    ("weeks_on_chart", "weeks_on_chart", safe_int),
    ("consecutive_weeks", "consecutive_weeks", safe_int),
    ("entry_status", "entry_status", F.col),
    ("entry_rank", "entry_rank", safe_int),
    ("entry_date", "entry_date", safe_date),
    ("release_date", "release_date", safe_date),
    ("release_date", "release_date_raw", F.col),
    ("entry_rank", "entry_rank_raw", F.col),
)
_STUDY = ("date", "country", "rank", "uri", "artist_name", "days_on_chart")


def _typed(raw: DataFrame, columns: Iterable[tuple[str, str, Parser]]) -> DataFrame:
    return raw.select(*[parse(source).alias(name) for source, name, parse in columns])


def artists_daily(raw: DataFrame) -> DataFrame:
    """Typed daily artist chart from its all-text form."""
    return _typed(raw, _ARTISTS)


def albums_weekly(raw: DataFrame) -> DataFrame:
    """Typed weekly album chart from its all-text form, with the days from release to entry."""
    return with_release_lag(_typed(raw, _ALBUMS))


def with_release_lag(albums: DataFrame) -> DataFrame:
    return albums.withColumn("days_release_to_entry", F.datediff("entry_date", "release_date"))


def study_rows(raw: DataFrame) -> DataFrame:
    """The six columns of the cohort study, parsed by the same guarded rules."""
    own_name = {"date", "country"}
    chosen = [
        (source, source if source in own_name else name, parse)
        for source, name, parse in _ARTISTS
        if source in _STUDY
    ]
    return _typed(raw, chosen)
