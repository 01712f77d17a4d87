"""Bands, classes and their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankscope import vocabulary as v

Bands = Sequence[tuple[int | None, str]]


def band(name: str, bands: Bands) -> Column:
    """Name of the first band whose upper bound is not exceeded.

    The last band is open and has no NULL branch: a NULL value lands in it, so filter NULLs first.
    """
    (first, label), *others = bands[:-1]
    chain = F.when(F.col(name) <= first, label)
    for upper, label in others:
        chain = chain.when(F.col(name) <= upper, label)
    return chain.otherwise(bands[-1][1])


def rank_band(name: str) -> Column:
    return band(name, v.RANK_BANDS)


def lag_bucket(name: str) -> Column:
    return band(name, v.LAG_BUCKETS)


def band_order(name: str, bands: Bands) -> Column:
    """Position of a band name in its list, NULL for a name not in it."""
    pairs = [F.lit(x) for i, (_, label) in enumerate(bands) for x in (label, i)]
    return F.try_element_at(F.create_map(*pairs), F.col(name))


def two_way(condition: Column, yes: str, no: str) -> Column:
    """``yes`` where the condition holds; ``no`` where it is false or unknown."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def tenure_class(name: str, above: int = v.VETERAN_AFTER) -> Column:
    return two_way(F.col(name) > above, v.VETERAN, v.NEWCOMER)


def scope_class(name: str, above: int = v.GLOBAL_AFTER) -> Column:
    return two_way(F.col(name) > above, v.GLOBAL, v.LOCAL)


def tier_class(name: str, until: int = v.TOP_UNTIL) -> Column:
    return two_way(F.col(name) <= until, v.TOP, v.STABLE)


def all_strata() -> list[str]:
    """The keys of every combination of classes."""
    return [
        f"{tenure}-{scope}-{tier}"
        for tenure in (v.NEWCOMER, v.VETERAN)
        for scope in (v.GLOBAL, v.LOCAL)
        for tier in (v.STABLE, v.TOP)
    ]


def stratum_key(*names: str) -> Column:
    """Class names joined by ``-``. A NULL part is left out, so the key itself is never NULL."""
    return F.concat_ws("-", *names)
