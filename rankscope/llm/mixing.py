"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

Leaves are the (domain, language, source) triples of the rows. A token budget flows from the root
down the tree: at each node it is split among the children by their weights; a child that cannot
use its share, because its rows hold fewer tokens times the epochs allowed, leaves the rest to its
siblings, and only what no sibling can take goes back to the parent's siblings. All of that is
integer arithmetic over one row per tree node. A leaf then takes whole rows in seeded order, epoch after
epoch, while the tokens before a row are below its budget.

NULL domain, language or source is the child named ``""``. NULL and empty texts cost one token. A
weight that is missing, 0 or below counts as 1. The order is a hash of seed, epoch, cost, text and key, so rows
that share or lack a key are spread like all others; only rows equal in key and text stand together, and which
of these comes first changes nothing but their other columns. A very long text is one row with its cost, an empty
table gives no rows, and columns of any name travel inside ``row``.
A leaf is never ordered in one task: rows fall into bins of their order, and only the bin in which the
budget ends is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankscope.llm.common import hex_number, store

LEVELS = ("domain", "lang", "source")
ROWS_PER_BIN = 1024
#: leaves (narrow rows) that may be broadcast
BROADCAST_LEAVES = 100_000
ORDER_HEX = 13
WIDE = "decimal(38,0)"


def token_cost(text: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up, at least 1."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast("long")


def split_budget(nodes: DataFrame, parent: Sequence[str], name: str, budget: str = "budget") -> DataFrame:
    """Each child's part of its parent's ``budget``.

    ``nodes`` has one row per child with ``room`` (most tokens it can take), ``weight`` and the
    parent's budget. Children fill up in order of room per weight. One is full if the budget left
    after those before it, split by the weights from it on, gives it at least its room; the others
    share what is left by weight. Parts are rounded down, the tokens left over by rounding go one
    each to the first children that are not full.
    """
    group = Window.partitionBy(*parent)
    order = group.orderBy((F.col("room").cast("double") / F.col("weight")), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wide = lambda c: c.cast(WIDE)
    sums = nodes.withColumns({
        "__used": F.coalesce(F.sum(wide(F.col("room"))).over(before), F.lit(0).cast(WIDE)),
        "__weights": F.sum(wide(F.col("weight"))).over(onward),
    })
    fits = wide(F.col("room")) * F.col("__weights") <= (
        wide(F.col(budget)) - F.col("__used")
    ) * wide(F.col("weight"))
    # once a child is not full, none after it is
    full = sums.withColumn("__full", F.min(fits.cast("int")).over(order) == 1)
    left = full.withColumns({
        "__rest": wide(F.col(budget)) - F.coalesce(F.sum(wide(F.when(F.col("__full"), F.col("room")))).over(group), F.lit(0).cast(WIDE)),
        "__open": F.sum(wide(F.when(~F.col("__full"), F.col("weight")))).over(group),
    })
    share = F.expr("__rest * cast(weight as decimal(38,0)) div __open")
    parts = left.withColumn("__share", F.when(F.col("__full"), F.col("room")).otherwise(share))
    spare = F.col("__rest").cast("long") - F.sum(F.when(~F.col("__full"), F.col("__share"))).over(group)
    place = F.row_number().over(group.orderBy("__full", name))
    extra = F.when(~F.col("__full") & (place <= spare), 1).otherwise(0)
    return parts.withColumns({"__spare": spare, "__place": place}).withColumn(
        "part", F.least(F.col("room"), F.col("__share") + extra)
    ).select(*nodes.columns, "part")


def budgets(leaves: DataFrame, total: Column, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """One row per leaf with its ``budget``. ``leaves`` has the levels and ``room``.

    ``weights`` maps a level to integer weights by name; ``total`` is taken over all leaves.
    """

    def weight(level: str) -> Column:
        known = weights.get(level, {})
        chosen = F.lit(1)
        for value, w in known.items():
            chosen = F.when(F.col(level) == value, F.lit(max(1, int(w)))).otherwise(chosen)
        return chosen.cast("long")

    done: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("room").alias("room")).withColumn("weight", weight(level))
        if done is None:
            nodes = nodes.withColumn("__root", F.lit(0))
            all_room = F.sum("room").over(Window.partitionBy("__root"))
            nodes = nodes.withColumn("all_room", all_room)
            nodes = nodes.withColumn("budget", F.least(total, F.col("all_room"))).drop("all_room")
            parent = ["__root"]
        else:
            nodes = nodes.join(done, list(LEVELS[:depth]))
            parent = list(LEVELS[:depth])
        split = split_budget(nodes, parent, level)
        done = split.select(*path, F.col("part").alias("budget"))
    return done


def select(
    docs: DataFrame,
    share: float,
    weights: Mapping[str, Mapping[str, int]],
    domain: Column,
    seed: int = 1,
    epochs: int = 1,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows that the leaves take: ``row`` (all columns of ``docs``), the leaf, epoch and tokens.

    ``share`` is the part of all tokens to take; with ``epochs`` above 1 a row can be taken once in
    each, in a new order. ``tokens_before`` counts the leaf's tokens ahead of the row.
    """
    level = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        level(domain).alias("domain"), level(docs[lang]).alias("lang"), level(docs[source]).alias("source"),
        F.coalesce(docs[key].cast("string"), F.lit("")).alias("key"), token_cost(docs[text]).alias("n_tokens"),
        F.md5(F.coalesce(docs[text], F.lit(""))).alias("mark"),
    )
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"))
    leaves = leaves.withColumn("room", F.col("tokens") * epochs)
    total = F.floor(F.col("all_room") * F.lit(share) / epochs).cast("long")
    given = budgets(leaves, total, weights).join(leaves, list(LEVELS))
    # each leaf's row order is cut into bins of a few thousand rows
    given = store(given.withColumn("bins", F.ceil(F.col("n_rows") / ROWS_PER_BIN).cast("long")))
    if given.count() <= BROADCAST_LEAVES:
        given = F.broadcast(given)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    ranked = rows.select("*", rounds.alias("epoch")).withColumn(
        "place",
        hex_number(F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", "n_tokens", "mark", "key")), 1, ORDER_HEX),
    )
    binned = ranked.join(given, list(LEVELS)).withColumn(
        "bin", F.expr(f"cast(place as decimal(38,0)) * bins div {16**ORDER_HEX}")
    )
    sums = binned.groupBy(*LEVELS, "epoch", "bin").agg(
        F.sum("n_tokens").alias("in_bin"), F.first("budget").alias("budget")
    )
    ahead = Window.partitionBy(*LEVELS).orderBy("epoch", "bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before_bin", F.coalesce(F.sum("in_bin").over(ahead), F.lit(0)))
    starts = starts.filter(F.col("before_bin") < F.col("budget")).select(*LEVELS, "epoch", "bin", "before_bin")
    reached = binned.join(starts, [*LEVELS, "epoch", "bin"])
    inside = Window.partitionBy(*LEVELS, "epoch", "bin").orderBy("place", "key", "n_tokens", "mark")
    within = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = reached.withColumn("tokens_before", F.col("before_bin") + within - F.col("n_tokens"))
    return taken.filter(F.col("tokens_before") < F.col("budget")).select(
        "row", *LEVELS, "epoch", "n_tokens", "tokens_before", "budget"
    )
