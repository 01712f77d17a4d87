"""Exact quantiles against sorting, on groups of odd shapes."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest

from rankscope.operators.profiling import exact_quartiles
from rankscope.operators.quantiles import QUARTILES, exact_quantiles

SHARES = {"least": 0.0, **QUARTILES, "most": 1.0}


def brute(rows, shares):
    groups = defaultdict(list)
    for group, value in rows:
        if value is not None and value == value:
            groups[group].append(value)
    out = {}
    for group, values in groups.items():
        values.sort()
        out[group] = (len(values), *[values[max(1, math.ceil(len(values) * p)) - 1] for p in shares.values()])
    return out


@pytest.mark.parametrize("bins", [1, 2, 16, 256])
def test_equals_sorting(spark, bins):
    rows = [("hot", 1e12 + i * 0.25) for i in range(2000)]  # close together and far from zero
    rows += [(f"g{i % 5}", float((i * 37) % 101 - 50)) for i in range(500)]
    rows += [("few", 3.0)] * 40 + [("one", -7.5), ("none", None), ("nan", math.nan), ("nan", 1.0)]
    rows += [(None, float(i)) for i in range(9)] + [("wide", s * 10.0**e) for e in range(-30, 300, 3) for s in (-1, 1)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {r.g: tuple(r)[1:] for r in exact_quantiles(df, ["g"], "v", SHARES, bins).collect()}
    assert found == brute(rows, SHARES)


def test_several_or_no_group_columns_and_whole_numbers(spark):
    rows = [(i % 2, None if i % 3 else "x", i * 7 % 50) for i in range(120)]
    df = spark.createDataFrame(rows, "a int, b string, v int")
    found = {(r.a, r.b): tuple(r)[2:] for r in exact_quantiles(df, ["a", "b"], "v").collect()}
    assert found == brute([((a, b), v) for a, b, v in rows], QUARTILES)
    assert tuple(exact_quantiles(df, [], "v").first()) == brute([(0, v) for *_, v in rows], QUARTILES)[0]
    assert exact_quantiles(df.limit(0), ["a"], "v").count() == 0


def test_no_stretch_holds_much_of_a_group_of_near_equal_values(spark):
    """Values whose magnitudes are one: a cut by magnitude would put all in one place."""
    from pyspark.sql import functions as F

    from rankscope.operators.ordering import even_bins

    counts = spark.range(10_000).select(F.lit("g").alias("g"), (F.lit(1e9) + F.col("id")).alias("v"))
    largest = even_bins(counts, "g", "v", 64).groupBy("__bin").count().agg(F.max("count")).first()[0]
    assert largest < 10_000 / 64 * 2


def test_quartiles_of_columns_evaluate_the_table_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as float) / 3 as x", "'t' as t").write.parquet(str(tmp_path / "in"))
    made = exact_quartiles(spark.read.parquet(str(tmp_path / "in")))
    assert f"{tmp_path}/in" not in made._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: r.q50 for r in made.collect()}["id"] == 49.0
