"""Exact quantiles of a group of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope.operators.ordering import bin_offsets, even_bins
from rankscope.sources.stored import stored

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, shares: Mapping[str, float] = QUARTILES, bins: int = 256
) -> DataFrame:
    """Per group the smallest ``value`` that each share of its rows reaches, and ``count``, its rows.

    Rows are counted per group and value before they are shuffled, and these counts are stored, so ``df``
    is evaluated once and repeated values cost nothing. A group's values are cut into even stretches;
    a table of one row per group and stretch tells what lies before each. No task sorts a group. NULL and
    NaN are left out; a group of nothing else is absent; a NULL in ``groups`` is a value of its own.
    """
    names = list(groups)
    number = F.col(value).cast("double")
    group = F.struct(*[F.col(g) for g in names]) if names else F.struct(F.lit(0).alias("all"))
    counts = stored(
        df.filter(number.isNotNull() & ~F.isnan(number))
        .groupBy(group.alias("__group"), F.col(value).alias("__value"))
        .agg(F.count("*").alias("n"))
    )
    binned = even_bins(counts, "__group", "__value", bins)
    offsets = bin_offsets(binned, "__group", "__bin", {"n": F.sum("n")}).drop("n_in")
    within = Window.partitionBy("__group", "__bin").orderBy("__value")
    reached = F.col("n_before") + F.sum("n").over(within)
    placed = binned.join(offsets, ["__group", "__bin"]).withColumn("__reached", reached)
    found = placed.groupBy("__group").agg(
        F.max("n_all").alias("count"),
        *[F.min(F.when(F.col("__reached") >= F.ceil(F.col("n_all") * p), F.col("__value"))).alias(q) for q, p in shares.items()],
    )
    return found.select(*[F.col(f"__group.{g}").alias(g) for g in names], "count", *shares)
