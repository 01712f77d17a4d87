"""Sharding by balanced label propagation.

Documents that share a link (here: an equal text; a document has one) should lie in one shard, and
shards must be even. All start where their hash puts them. Each round every link that is not settled asks for the shard that
holds most of its documents among those that still have room for all of them. A shard lets in the
largest first, each whole or not at all; who was refused asks again, until no link that is left fits
anywhere. Links larger than a shard are settled first, on shards that follow each other. Fewer links than
shards are left at the end; they go whole to the shard with most room. Rows alone fill the room that
is left. The rows are laid out by shard and link and cut into equal parts, so the counts differ by one at
most and only the link that stands at a cut is parted; rows alone stand around the cuts.

NULL text counts as the empty text, of size 1. Repeated rows are one node with a weight and come back
as often as they were. A row without id is a node like others. Ties between shards fall by the
link's own order of shards, so the documents of a link agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankscope.llm.common import store

MOVE_BINS = 256
ORDER_BINS = 1024


def _unit(*columns: Column | str, seed: int) -> Column:
    """A reproducible number from 0 to 1."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def _large(linked: DataFrame, shards: int, total: int) -> tuple[dict[str, int], list[float]]:
    """First shards of the links with more rows than a shard, and the room that they leave in each shard.

    There are fewer of them than shards. Each starts with a shard where that leaves room for all.
    """
    share = total / shards
    rows = linked.filter(F.col("link_weight") * shards > total).select("link", "link_weight").collect()
    rows.sort(key=lambda r: (-r["link_weight"], r["link"]))
    aligned = sum(-(-r["link_weight"] * shards // total) for r in rows) <= shards
    firsts, rooms, at = {}, [share] * shards, 0.0
    for r in rows:
        first = min(shards - 1, int(at / share + 1e-9))
        firsts[r["link"]] = first
        end = at + r["link_weight"]
        for s in range(shards):
            rooms[s] -= max(0.0, min(end, (s + 1) * share) - max(at, s * share))
        at = -(-r["link_weight"] * shards // total) * share + at if aligned else end
    return firsts, [max(0.0, room) for room in rooms]


def settle(linked: DataFrame, shards: int, total: int) -> tuple[DataFrame, list[float]]:
    """``linked`` (link, link_weight, tally) to (link, shard), and the room left in each shard."""
    spark = linked.sparkSession
    firsts, rooms = _large(linked, shards, total)
    schema = "link string, shard int"
    settled = [spark.createDataFrame(list(firsts.items()), schema)]
    waiting = linked.filter(F.col("link_weight") * shards <= total)
    start = F.pmod(F.xxhash64("link"), F.lit(shards))
    turn = 0
    while True:
        # NULL where the link does not fit; the largest of the others is the wish
        choices = [
            F.when(
                F.col("link_weight") <= rooms[s] + 1e-6,
                F.struct(F.col("tally")[s].alias("v"), F.pmod(F.lit(s) - start, F.lit(shards)).alias("turn"), F.lit(s).alias("s")),
            )
            for s in range(shards)
        ]
        wishes = store(
            waiting.withColumn("to", F.array_max(F.array(*choices))["s"])
            .withColumn("step", F.floor(F.log2(F.col("link_weight"))).cast("int"))
            .withColumn("bin", F.floor(_unit("link", seed=turn) * MOVE_BINS).cast("int"))
        )
        asked = wishes.filter("to is not null").groupBy("to", "step", "bin").agg(F.sum("link_weight").alias("asking"))
        # at most shards * 64 * MOVE_BINS rows, however many documents
        order = Window.partitionBy("to").orderBy(F.desc("step"), "bin").rowsBetween(Window.unboundedPreceding, -1)
        room = F.array(*[F.lit(float(r)) for r in rooms])[F.col("to")]
        bins = asked.withColumn("free", room - F.coalesce(F.sum("asking").over(order), F.lit(0)))
        inside = Window.partitionBy("to", "step", "bin").orderBy("link").rowsBetween(Window.unboundedPreceding, 0)
        joined = wishes.join(F.broadcast(bins.filter("free > 0")), ["to", "step", "bin"])
        whole = joined.filter("asking <= free + 1e-6").select("link", F.col("to").alias("shard"), "link_weight")
        parted = joined.filter("asking > free + 1e-6").withColumn("upto", F.sum("link_weight").over(inside))
        parted = parted.filter("upto <= free + 1e-6").select("link", F.col("to").alias("shard"), "link_weight")
        moved = store(whole.unionByName(parted))
        taken = {r["shard"]: r["w"] for r in moved.groupBy("shard").agg(F.sum("link_weight").alias("w")).collect()}
        rooms = [max(0.0, room - taken.get(s, 0)) for s, room in enumerate(rooms)]
        columns = ["link", "link_weight", "tally"]
        waiting = store(wishes.join(moved.select("link"), "link", "left_anti").select(columns))
        settled.append(moved.select("link", "shard"))
        turn += 1
        least = waiting.agg(F.min("link_weight")).first()[0]
        if least is None or least > max(rooms) + 1e-6:
            break
    # what is left is larger than any room, and all rooms together hold it: fewer links than shards
    rest = []
    for r in sorted(waiting.select("link", "link_weight").collect(), key=lambda r: (-r["link_weight"], r["link"])):
        shard = max(range(shards), key=lambda s: (rooms[s], -s))
        rooms[shard] -= r["link_weight"]
        rest.append((r["link"], shard))
    settled.append(spark.createDataFrame(rest, schema))
    return reduce(DataFrame.unionByName, settled), [max(0.0, room) for room in rooms]


def _dealt(rooms: list[float]) -> Column:
    """Shards of the rows alone: dealt in proportion to the room that the linked ones leave."""
    weights = rooms if sum(rooms) > 0 else [1.0] * len(rooms)
    dealt, before, shard = _unit("node", seed=5) * sum(weights), 0.0, F.lit(0)
    for s, room in enumerate(weights):
        if room > 0:
            shard = F.when(dealt >= before, F.lit(s)).otherwise(shard)
        before += room
    return shard.cast("int")


def lay_out(placed: DataFrame, total: int) -> DataFrame:
    """Places of rows laid out by shard and link.

    ``placed`` has node, weight (rows of the node), shard, link and ``link_weight``. Adds ``first``, the
    node's first place among all ``total`` rows. Bins keep any one task small; a link with more
    rows than a bin's share is spread over bins of its own. Links stand in the middle of their shard,
    rows alone on both sides.
    """
    large = F.col("link_weight") * ORDER_BINS > total
    spread = _unit("link", seed=7) * ORDER_BINS
    aside = F.when(spread < ORDER_BINS / 2, spread - ORDER_BINS).otherwise(spread + ORDER_BINS)
    binned = placed.withColumns({
        "b1": F.floor(F.when(F.col("link_weight") > 1, spread).otherwise(aside)).cast("int"),
        "b2": F.when(large, F.xxhash64("link")).otherwise(F.lit(-(1 << 63)).cast("long")),
        "b3": F.when(large, F.floor(_unit("node", seed=8) * ORDER_BINS * F.col("link_weight") / total)).otherwise(0).cast("int"),
    })
    sums = binned.groupBy("shard", "b1", "b2", "b3").agg(F.sum("weight").alias("in_bin"))
    within_shard = Window.partitionBy("shard").orderBy("b1", "b2", "b3").rowsBetween(Window.unboundedPreceding, -1)
    by_shard = sums.groupBy("shard").agg(F.sum("in_bin").alias("in_shard"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    by_shard = by_shard.withColumn("ahead", F.coalesce(F.sum("in_shard").over(ahead), F.lit(0)))
    starts = sums.withColumn("before", F.coalesce(F.sum("in_bin").over(within_shard), F.lit(0)))
    starts = starts.join(by_shard, "shard").withColumn("start", F.col("ahead") + F.col("before"))
    inside = Window.partitionBy("shard", "b1", "b2", "b3").orderBy("link", "node").rowsBetween(Window.unboundedPreceding, -1)
    joined = binned.join(starts.select("shard", "b1", "b2", "b3", "start"), ["shard", "b1", "b2", "b3"])
    return joined.withColumn("first", F.col("start") + F.coalesce(F.sum("weight").over(inside), F.lit(0)))


def shard_texts(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, crc, law ``rows``, shard, slot, ``grown_shard`` NULL."""
    content = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        docs[key].alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(F.encode(content, "utf-8")).alias("text_crc32"),
        F.md5(F.encode(content, "utf-8")).alias("link"),
    )
    nodes = rows.groupBy("doc_id", "link").agg(
        F.count("*").alias("weight"), F.first("size").alias("size"), F.first("text_crc32").alias("text_crc32")
    )
    nodes = store(nodes.withColumn("node", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "link"))))
    total = nodes.agg(F.sum("weight")).first()[0] or 0
    begun = F.pmod(F.xxhash64("node"), F.lit(shards))
    tally = F.array(*[F.sum(F.when(begun == s, F.col("weight")).otherwise(0)) for s in range(shards)])
    groups = store(nodes.groupBy("link").agg(F.sum("weight").alias("link_weight"), tally.alias("tally")))
    linked = groups.filter("link_weight > 1").select("link", "link_weight", "tally")
    settled, rooms = settle(linked, shards, total)
    known = store(groups.select("link", "link_weight").join(settled, "link", "left"))
    with_links = nodes.join(known, "link")
    placed = lay_out(with_links.withColumn("shard", F.coalesce("shard", _dealt(rooms))), max(1, total))
    places = F.sequence(F.col("first"), F.col("first") + F.col("weight") - 1)
    each = placed.select("doc_id", "size", "text_crc32", F.explode(places).alias("place"))
    return each.select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("rows").alias("law"),
        F.expr(f"cast(place * {shards} div {max(1, total)} as int)").alias("shard"),
        F.expr(f"place - ((place * {shards} div {max(1, total)}) * {total} + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
