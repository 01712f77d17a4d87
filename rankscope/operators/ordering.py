"""Ranks and running totals inside groups of any size.

A window over a whole group sorts that group in one task, and one stratum may hold nearly half of
all rows. Here each group is cut into bins that follow the sort order. A small table holds what lies
before each bin, and the window then runs inside one bin only. The result is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankscope.sources.stored import stored


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """A seeded order that depends only on the row's key, equal on every run and layout.

    Each part stands with its length, and a NULL as ``-``, so no two keys look alike.
    """

    def part(key: str) -> Column:
        text = F.col(key).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part(k) for k in keys]))


EXACT_BELOW = 64
BINS_PER_DOUBLING = 64
KEYS_PER_BIN = 65_536


#: starts of bins that a join broadcasts, after they were counted
BROADCAST_ROWS = 1_000_000


#: rows that a task of a window should sort; a few times as many still fit its memory
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """``df`` shuffled by ``keys`` into parts for at most ``rows`` rows in all, for windows that partition by them.

    Without a number the engine chooses: it joins parts until their compressed size is that of a task, and rows that
    compress well may then fill many times that memory and spill where they are sorted.
    """
    if rows is None:
        return df
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.repartition(parts, *keys)


def rank_in_bins(
    df: DataFrame, groups: Sequence[str], bins: Mapping[str, Column], ahead: Sequence[Column], order: Sequence, rank: str,
    rows: int | None = None,
) -> DataFrame:
    """Row number per group along ``order``, where ``bins`` cut a group into consecutive stretches.

    ``ahead`` orders the bins of a group. The input is evaluated and shuffled once: rows get their number
    inside their bin and are stored; the rows of the bins that come before are added from the bins' counts,
    a table of one row per group and bin. No group of ``groups`` may be NULL. ``rows``, an upper bound of the
    rows if known, bounds the rows that a task sorts.
    """
    keys = [*groups, *bins]
    within = Window.partitionBy(*keys).orderBy(*order)
    held = stored(dealt(df.withColumns(dict(bins)), keys, rows).withColumn("__row", F.row_number().over(within)))
    counts = held.groupBy(*keys).agg(F.max("__row").cast("long").alias("__n"))
    earlier = Window.partitionBy(*groups).orderBy(*ahead).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")))
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    place = F.col("__before") + F.col("__row")
    return held.join(starts, keys).withColumn(rank, place).select(*df.columns, rank)


def rank_by_score(
    df: DataFrame, groups: Sequence[str], score: str, key: str, rank: str, rows: int | None = None
) -> DataFrame:
    """Row number per group by falling whole-number ``score``, ties to the smaller number ``key``.

    A group is cut into bins that follow this order: one per small score, further cut by key, since
    many rows share these, and one per narrow range of larger scores.
    """
    s, low = F.col(score), F.col(score) < EXACT_BELOW
    steps = F.floor(F.log2(F.greatest(s, F.lit(1)).cast("double")) * BINS_PER_DOUBLING)
    bins = {
        "__bin": F.when(low, s).otherwise(steps + EXACT_BELOW).cast("long"),
        "__part": F.when(low, F.floor(F.col(key) / KEYS_PER_BIN)).otherwise(0).cast("long"),
    }
    ahead = [F.desc("__bin"), F.col("__part")]
    ranked = rank_in_bins(df, groups, bins, ahead, [F.desc(score), key], rank, rows)
    return ranked.withColumn(rank, F.col(rank).cast("int"))


def hash_bin(name: str, digits: int = 3) -> Column:
    """The leading hex digits of a hash: ``16 ** digits`` even bins in hash order."""
    return F.substring(name, 1, digits)


def hash_draw(name: Column) -> Column:
    """The first 52 bits of a hash in hex as a number from 0 to 1, which a double holds exactly."""
    return F.conv(F.substring(name, 1, 13), 16, 10).cast("double") / float(1 << 52)


def even_bins(counts: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Adds ``__bin``, from 0 up: about ``bins`` stretches (the next power of two) of ``value``, even in a group.

    ``counts`` has a row for each group and distinct value. The cuts are a sketch of the group, made inside the
    plan; they only balance the work, whatever values lie close together. ``group`` must not be NULL.
    """
    bins = 1 << max(1, (bins - 1).bit_length())
    shares = [i / bins for i in range(1, bins)]
    cuts = counts.groupBy(group).agg(F.percentile_approx(value, shares, 8 * bins).alias("__cuts"))
    binned = counts.join(cuts, group).withColumn("__bin", F.lit(0))
    step = bins // 2
    while step:  # the number of cuts below the value, by halving
        below = F.get("__cuts", F.col("__bin") + (step - 1)) < F.col(value)
        binned = binned.withColumn("__bin", F.col("__bin") + F.when(below, step).otherwise(0))
        step //= 2
    return binned.drop("__cuts")


def bin_offsets(
    df: DataFrame, group: str, bin_column: str, totals: Mapping[str, Column]
) -> DataFrame:
    """Per group and bin, each total in the bin, before it, and of the whole group.

    Columns ``<name>_in``, ``<name>_before`` and ``<name>_all``. There is one row per group and bin,
    so a window holds at most as many rows as there are bins.
    """
    sums = df.groupBy(group, bin_column).agg(*[t.alias(f"{n}_in") for n, t in totals.items()])
    whole = Window.partitionBy(group)
    earlier = whole.orderBy(bin_column).rowsBetween(Window.unboundedPreceding, -1)
    before = {n: F.coalesce(F.sum(f"{n}_in").over(earlier), F.lit(0)) for n in totals}
    return sums.withColumns(
        {f"{n}_before": c for n, c in before.items()}
        | {f"{n}_all": F.sum(f"{n}_in").over(whole) for n in totals}
    )


def rank_in_group(
    df: DataFrame, group: str, order: str, rank: str = "row_in_group", digits: int = 3
) -> DataFrame:
    """Row number inside ``group`` along a hash column, from 1. ``group`` must not be NULL."""
    bins = {"__bin": hash_bin(order, digits)}
    return rank_in_bins(df, [group], bins, [F.col("__bin")], [order], rank)
