"""Column helpers: malformed text, NULLs, bounds of bands."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions import aggregates, banding, parsing, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("raw", "parsed"),
    [
        ("12", 12), ("-3", -3), ("007", 7), (" 12", None), ("12.0", None), ("x", None), ("", None),
        ("99999999999", None), (None, None), ("+5", None),
    ],
)
def test_safe_int(spark, raw, parsed):
    df = spark.createDataFrame([(raw,)], "c string")
    assert values(df, parsing.safe_int("c")) == [parsed]


@pytest.mark.parametrize(
    ("raw", "parsed"),
    [
        ("2023-02-28", dt.date(2023, 2, 28)), ("2023-02-30", None), ("2023", None), ("", None),
        ("2023-2-8", None), ("2023-02-28 ", None), (None, None),
    ],
)
def test_safe_date(spark, raw, parsed):
    df = spark.createDataFrame([(raw,)], "c string")
    assert values(df, parsing.safe_date("c")) == [parsed]


def test_malformed_needs_a_raw_value(spark):
    df = spark.createDataFrame([("x", None), (None, None), ("1", 1)], "raw string, parsed int")
    assert values(df, parsing.malformed("raw", "parsed")) == [True, False, False]


def test_text_default_trims_only_to_test(spark):
    df = spark.createDataFrame([(" a ",), ("  ",), ("",), (None,)], "c string")
    assert values(df, parsing.text_or_default("c", "none")) == [" a ", "none", "none", "none"]


def test_rank_bands(spark):
    ranks = [1, 10, 11, 25, 26, 50, 51, 100, 101, 200, 999, None]
    df = spark.createDataFrame([(r,) for r in ranks], "rank int")
    assert values(df, banding.rank_band("rank")) == [
        "1-10", "1-10", "11-25", "11-25", "26-50", "26-50", "51-100", "51-100",
        "101-200", "101-200", "101-200", "101-200",
    ]


def test_lag_buckets_and_order(spark):
    df = spark.createDataFrame([(d,) for d in (0, 7, 8, 30, 31, 180, 181, 365, 366)], "lag int")
    named = df.withColumn("bucket", banding.lag_bucket("lag"))
    order = banding.band_order("bucket", v.LAG_BUCKETS)
    assert values(named, order) == [0, 0, 1, 1, 2, 2, 3, 3, 4]
    unknown = spark.createDataFrame([("nope",)], "bucket string")
    assert values(unknown, order) == [None]


def test_two_way_classes_send_unknown_to_the_second(spark):
    df = spark.createDataFrame([(365, 10, 50), (366, 11, 51), (None, None, None)],
                               "days int, markets int, rank int")
    assert values(df, banding.tenure_class("days")) == ["Nuevo", "Veterano", "Nuevo"]
    assert values(df, banding.scope_class("markets")) == ["Local", "Global", "Local"]
    assert values(df, banding.tier_class("rank")) == ["Top", "Estable", "Estable"]


def test_stratum_key_skips_missing_parts(spark):
    df = spark.createDataFrame([("a", "b", "c"), (None, None, "c"), (None, None, None)],
                               "x string, y string, z string")
    assert values(df, banding.stratum_key("x", "y", "z")) == ["a-b-c", "c", ""]


def test_share_counts_unknown_as_not_holding(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("A",)], "s string")
    assert df.agg(aggregates.share_when(F.col("s") == "A")).first()[0] == 0.5


def test_distinct_rows_counts_null_once(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), (None,)], "s string")
    assert df.agg(aggregates.distinct_rows("s")).first()[0] == 3
    assert df.filter("s is not null").agg(aggregates.distinct_rows("s")).first()[0] == 2
    assert df.limit(0).agg(aggregates.distinct_rows("s")).first()[0] == 0


def test_median_is_the_lower_one_and_ignores_null(spark):
    df = spark.createDataFrame([(x,) for x in (4, 1, 3, 2, None)], "x int")
    assert df.agg(aggregates.median("x")).first()[0] == 2
    assert df.filter("x is null").agg(aggregates.median("x")).first()[0] is None


def test_sketched_median_is_within_its_rank_error(spark):
    df = spark.range(0, 50_001, numPartitions=8).select(((F.col("id") * 7919) % 50_001).alias("x"))
    sketched = df.agg(aggregates.median("x", accuracy=1000)).first()[0]
    assert abs(sketched - 25_000) <= 50_001 / 1000
    assert df.agg(aggregates.median("x")).first()[0] == 25_000


def test_guarded_percent(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "part int, whole int")
    assert values(df, aggregates.guarded_percent(F.col("part"), F.col("whole"), 4)) == [33.3333, None]


def test_numbers_in_words(spark):
    df = spark.createDataFrame([(0.1234, 1234567.9)], "p double, n double")
    assert values(df, text.percent_text(F.col("p"), 2)) == ["12.34%"]
    assert values(df, text.thousands_text(F.col("n"))) == ["1,234,567"]
