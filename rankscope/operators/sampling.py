"""Stratified samples and folds, and the checks on them.

All but two order or draw rows by a seeded hash of their natural key, so a sample is the same on every
cluster layout and after any lost executor. The engine's own seeded forms (``assign_folds_random``,
``with_running_id``) depend on the layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankscope import vocabulary as v
from rankscope.functions.aggregates import null_count
from rankscope.operators.cohort import strata_from_counts
from rankscope.operators.ordering import bin_offsets, hash_bin, hash_draw, hash_order, rank_in_group

#: what tells two chart rows apart
KEYS = ("country", "artist_uri", "date", "rank", "days_on_chart")
COMPLETE = (
    "country", "rank", "days_on_chart", "max_days_on_chart", "country_count_by_artist",
    "artist_tenure", "artist_scope", "rank_tier", "partition_id",
)


def sample_bernoulli(
    people: DataFrame,
    table: DataFrame,
    stratum: str = "partition_id",
    keys: Sequence[str] = KEYS,
    seed: int = v.SEED,
) -> DataFrame:
    """Each row kept with its stratum's fraction. Its size varies around the target.

    The draw of a row is the seeded hash of its key as a number from 0 to 1, so a sample is the same on
    every layout and after any retried task. Rows that repeat all keys are kept or left together.
    """
    fractions = table.select(stratum, F.col("fraction").alias("__fraction"))
    drawn = hash_draw(hash_order(keys, seed)) < F.col("__fraction")
    kept = people.join(F.broadcast(fractions), stratum).filter(drawn)
    return kept.select(*people.columns)


def sample_exact(
    people: DataFrame,
    target: int = v.SAMPLE_TARGET,
    stratum: str = "partition_id",
    keys: Sequence[str] = KEYS,
    seed: int = v.SEED,
    digits: int = 3,
) -> DataFrame:
    """The first ``n_i`` rows of each stratum in hash order.

    The rows per stratum and hash bin say in which bin a stratum reaches its quota. Rows in later
    bins are dropped where they are read, by the broadcast quotas, one row per stratum; only the kept ones
    are shuffled and ranked, bin by bin.
    ``people`` is read once for the counts and once for the rows: give it a stored table.
    """
    hashed = people.withColumn("__hash", hash_order(keys, seed)).withColumn(
        "__bin", hash_bin("__hash", digits)
    )
    bins = bin_offsets(hashed, stratum, "__bin", {"n": F.count("*")})
    per_stratum = bins.groupBy(stratum).agg(
        F.sum("n_in").alias("count"),
        F.collect_list(F.struct("__bin", "n_before")).alias("bins"),
    )
    # The last bin that still has room before it; a stratum with no quota has none.
    with_room = F.filter("bins", lambda b: b["n_before"] < F.col("n_i"))
    quotas = (
        strata_from_counts(per_stratum, target)
        .withColumn("last", F.array_max(with_room))
        .filter(F.col("last").isNotNull())
        .select(
            stratum,
            F.col("last.__bin").alias("__last_bin"),
            (F.col("n_i") - F.col("last.n_before")).alias("__room"),
        )
    )
    row = F.row_number().over(Window.partitionBy(stratum, "__bin").orderBy("__hash"))
    return (
        hashed.join(F.broadcast(quotas), stratum)
        .filter(F.col("__bin") <= F.col("__last_bin"))
        .withColumn("__row", row)
        .filter((F.col("__bin") < F.col("__last_bin")) | (F.col("__row") <= F.col("__room")))
        .select(*people.columns)
    )


def compare_strata(table: DataFrame, sample: DataFrame, stratum: str = "partition_id") -> DataFrame:
    """Share of each stratum in the population and in the sample, and the gap in points.

    ``table`` is the result of ``strata``. Both sides have one row per stratum.
    """
    shares = sample.groupBy(stratum).agg(F.count("*").alias("count_M"))
    total = F.sum("count_M").over(Window.partitionBy())
    shares = shares.withColumn("prop_M", F.col("count_M") / total)
    return (
        table.select(
            stratum, F.col("count").alias("count_P"), F.col("probability").alias("prop_P")
        )
        .join(shares, stratum)
        .withColumn("abs_diff_pct", F.abs(F.col("prop_P") - F.col("prop_M")) * 100)
        .orderBy(F.desc("count_P"), stratum)
    )


def complete_rows(sample: DataFrame, columns: Sequence[str] = COMPLETE) -> DataFrame:
    """Rows with a value in every listed column."""
    return sample.dropna(subset=list(columns))


def with_row_id(sample: DataFrame, keys: Sequence[str] = KEYS, seed: int = v.SEED) -> DataFrame:
    """``id`` from the identifying columns, equal on every run.

    Rows that repeat another in all of them get its id with their number behind it.
    """
    hashed = sample.withColumn("__hash", hash_order(keys, seed))
    repeat = F.row_number().over(Window.partitionBy("__hash").orderBy("__hash"))
    number = F.when(repeat > 1, F.concat(F.lit("-"), repeat.cast("string"))).otherwise("")
    return hashed.withColumn("id", F.concat("__hash", number)).drop("__hash")


def with_running_id(sample: DataFrame) -> DataFrame:
    """``id`` from the engine's increasing counter: unique, but it follows the layout."""
    return sample.withColumn("id", F.monotonically_increasing_id())


def assign_folds(
    sample: DataFrame,
    folds: int = v.FOLDS,
    stratum: str = "partition_id",
    keys: Sequence[str] = KEYS,
    seed: int = v.SEED,
    digits: int = 3,
) -> DataFrame:
    """``fold_id`` dealt in turn inside each stratum, along the ids or else the hash order."""
    order = F.col("id") if "id" in sample.columns else hash_order(keys, seed)
    hashed = sample.withColumn("__hash", order)
    ranked = rank_in_group(hashed, stratum, "__hash", "__row", digits)
    fold = ((F.col("__row") - 1) % folds).cast("int")
    return ranked.withColumn("fold_id", fold).drop("__hash", "__row")


def assign_folds_random(
    sample: DataFrame,
    folds: int = v.FOLDS,
    stratum: str = "partition_id",
    ties: Sequence[str] = ("artist_uri", "date"),
    seed: int = v.SEED,
) -> DataFrame:
    """``fold_id`` dealt in turn along a seeded random column, for small samples.

    The whole stratum is sorted in one task and the order follows the layout: prefer
    ``assign_folds``.
    """
    order = Window.partitionBy(stratum).orderBy(F.rand(seed), *ties)
    return sample.withColumn("fold_id", ((F.row_number().over(order) - 1) % folds).cast("int"))


def train_rows(sample: DataFrame, fold: int) -> DataFrame:
    return sample.filter(F.col("fold_id") != fold)


def test_rows(sample: DataFrame, fold: int) -> DataFrame:
    return sample.filter(F.col("fold_id") == fold)


def fold_sizes(sample: DataFrame) -> DataFrame:
    """Rows and percent per fold; the window runs over one row per fold."""
    total = F.sum("count").over(Window.partitionBy())
    return (
        sample.groupBy("fold_id")
        .count()
        .withColumn("pct_M", F.round(F.col("count") / total * 100, 2))
        .orderBy("fold_id")
    )


def split_sizes(sample: DataFrame) -> DataFrame:
    """Rows that each fold tests on and trains on; the window runs over one row per fold."""
    whole = F.sum("n_test").over(Window.partitionBy())
    tested = sample.groupBy("fold_id").agg(F.count("*").alias("n_test"))
    return tested.withColumn("n_train", whole - F.col("n_test")).orderBy("fold_id")


def fold_pivot(
    sample: DataFrame, folds: int = v.FOLDS, stratum: str = "partition_id"
) -> DataFrame:
    """Rows per stratum, one column per fold, 0 where a fold has none."""
    pivot = sample.groupBy(stratum).pivot("fold_id", list(range(folds))).count()
    return pivot.na.fill(0).orderBy(stratum)


def fold_checks(sample: DataFrame, folds: int = v.FOLDS, spread: int = v.FOLD_SPREAD) -> DataFrame:
    """One row: folds, rows, distinct ids, strata per fold, sizes, and whether all is in order.

    Strata and sizes come from the small table of rows per fold and stratum; the ids are counted in
    their own shuffle, so no task holds a whole fold.
    """
    cells = sample.groupBy("fold_id", "partition_id").count()
    strata_total = F.count_distinct("partition_id").alias("particiones_totales")
    per_fold = cells.groupBy("fold_id").agg(
        F.count("*").alias("strata"), F.sum("count").alias("size")
    )
    parts = [
        per_fold.agg(
            F.count("*").alias("folds_distintos"),
            F.sum("size").alias("registros_asignados"),
            F.min("strata").alias("particiones_por_fold_min"),
            F.min("size").alias("fold_min"),
            F.max("size").alias("fold_max"),
        ),
        cells.agg(strata_total),
        sample.agg(F.count_distinct("id").alias("ids_distintos")),
    ]
    return _one_row(parts).withColumns(
        {
            "five_balanced_folds": (F.col("folds_distintos") == folds)
            & (F.col("fold_max") - F.col("fold_min") <= spread),
            "unique_ids": F.col("ids_distintos") == F.col("registros_asignados"),
            "all_strata_in_folds": F.col("particiones_por_fold_min")
            == F.col("particiones_totales"),
        }
    )


def sample_checks(
    comparison: DataFrame,
    sample: DataFrame,
    target: int = v.SAMPLE_TARGET,
    expected_strata: int = 8,
    tolerance: float = v.SAMPLE_TOLERANCE,
    complete: Sequence[str] = COMPLETE,
) -> DataFrame:
    """One row: strata in both tables, sample size near the target, no row lost to cleaning.

    ``comparison`` is the result of ``compare_strata``.
    """
    complete_row = F.lit(True)
    for name in complete:
        complete_row = complete_row & F.col(name).isNotNull()
    parts = [
        comparison.agg(
            F.count("*").alias("strata"),
            F.max("abs_diff_pct").alias("max_abs_diff_pct"),
        ),
        sample.agg(
            F.count("*").alias("n_M"),
            F.count_if(complete_row).alias("n_M_clean"),
        ),
    ]
    return _one_row(parts).withColumns(
        {
            "all_strata_sampled": F.col("strata") == expected_strata,
            "size_near_target": F.abs(F.col("n_M") - target) / F.lit(target) < tolerance,
            "nothing_lost": F.col("n_M") == F.col("n_M_clean"),
        }
    )


def critical_nulls(sample: DataFrame, columns: Sequence[str] = COMPLETE) -> DataFrame:
    """One row with the NULL count of each column that must be filled."""
    return sample.agg(*[null_count(c).alias(c) for c in columns])


def class_share(
    sample: DataFrame, label: str = "rank_tier", fold: str = "fold_id"
) -> DataFrame:
    """Rows per fold and class with their percent of the fold."""
    of_fold = F.sum("count").over(Window.partitionBy(fold))
    return (
        sample.groupBy(fold, label)
        .count()
        .withColumn("pct_fold", F.col("count") / of_fold * 100)
        .orderBy(fold, label)
    )


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Several one-row tables side by side: stacked with NULLs, then the value of each column."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
