"""Joining a fact table with one row per entity when some entities hold a large part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankscope.sources.stored import stored

#: the longest list of heavy entities that is broadcast
MOST_HEAVY = 100_000
#: profiles from which on their join is one of hashed parts; fewer are left to the planner
HASHED_FROM = 200_000
#: places over which rows spread that need no partner from the shuffle
SPREAD = 4096


#: rows of a table that is broadcast after it was counted
BROADCAST_ROWS = 1_000_000


def one_per_key(side: DataFrame) -> DataFrame:
    """``side``, which has one row or few per key, marked for a join that does not sort the table it meets.

    It is counted (give it a stored or source table), then broadcast, or hashed part by part.
    """
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side.hint("shuffle_hash")


def heavy_entities(profile: DataFrame, key: str, rows: str, rows_per_task: int) -> DataFrame:
    """The entities with more than ``rows_per_task`` fact rows, the largest ``MOST_HEAVY`` of them at most."""
    return profile.filter(F.col(rows) > rows_per_task).orderBy(F.desc(rows), key).limit(MOST_HEAVY)


def left_join_by_entity(
    fact: DataFrame, profile: DataFrame, key: str, rows: str, rows_per_task: int = 2_000_000
) -> DataFrame:
    """Left join of ``fact`` with ``profile`` on ``key``; ``profile`` has one row per key.

    ``rows`` is the profile column with the number of fact rows of the key. The profile is evaluated once
    and stored. Its heavy keys are a short list, which is broadcast: their rows have their profile before
    the shuffle. They and rows with a NULL key then go through it under a spread number that no light key
    has, so ``fact`` is read once, shuffled once, and no task gets a heavy key. Where the light profiles are small
    the planner broadcasts them too, and nothing is shuffled; where they are many, a task hashes its profiles and
    does not sort the wide rows of ``fact``.
    """
    profile = stored(profile.filter(F.col(key).isNotNull()))
    values = [c for c in profile.columns if c not in (key, rows)]
    heavy = stored(heavy_entities(profile, key, rows, rows_per_task).select(key, F.struct(*values).alias("__heavy")))
    others = [c for c in fact.columns if c != key]
    marked = fact.join(F.broadcast(heavy), key, "left")
    alone = F.col("__heavy").isNotNull() | F.col(key).isNull()
    spread = F.when(alone, 1 + F.pmod(F.xxhash64(*others), F.lit(SPREAD))).otherwise(0).cast("int")
    # always 0, but no literal: the optimizer would drop a literal from the keys that the rows are dealt by
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    light = profile.join(F.broadcast(heavy), key, "left_anti").select(
        key, zero.alias("__spread"), F.struct(*values).alias("__light")
    )
    if profile.count() > HASHED_FROM:
        light = light.hint("shuffle_hash")
    joined = marked.withColumn("__spread", spread).join(light, [key, "__spread"], "left")
    found = [F.coalesce(f"__heavy.{c}", f"__light.{c}").alias(c) for c in values]
    return joined.select(key, *others, *found)
