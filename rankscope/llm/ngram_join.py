"""Documents that share most of their word five-grams: a size-aware heavy-light similarity join.

A document is the set of 64-bit hashes of its five-word shingles; two link when their Jaccard
similarity is at least 0.75. The result is one row per document with its class, so links inside
a class already known need not be found again.

Small sets enumerate the subsets of the size that a partner must share, for each partner size; sets with
an equal subset link. Large sets are found through inverted lists: shingles are ordered from rare to
frequent, and only a set's first ones, of which a partner must share one, are listed. The boundary is the
size at which enumerating costs more than scanning lists.

Order of the steps:

1. A first pass counts shingles in a sketch of fixed size (its cells give the order) and the sizes of small sets.
2. A second pass writes each document's size, digest of its set, subsets or list entries, and a few
   band keys of bottom hashes, and the parities of listed sets. Equal sets are one class by their digest.
3. Documents with equal band keys are checked against the most central of them. This only
   unites the bulk of large groups early; nothing depends on what it misses.
4. Lists with documents of one class only are dropped. In the others, each document outside the
   list's main class meets the documents of other classes. Where the sizes, the places in the lists,
   the parities of both sets and the number of shared list entries allow the similarity, the pair is a
   candidate. Candidates are checked exactly; classes are the components of all links.

NULL and empty texts have no shingles and link with nothing. A text of fewer than five words is one
shingle. A row without id gets no class. Rows with equal id count as one document if their texts are
equal; otherwise the id stands for all of them. No list, group or pair is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import discard, released, slices, store, strings
from rankscope.llm.components import components

WORDS = 5
CELL_BITS = 20
CHUNK = 4096
BINS, BANDS = 24, 8
FIRST_BITS = 24
REMEMBERED = 250_000
#: characters of texts that are cut in one go
TOGETHER = 3_000_000
MOST_SUBSETS = 4096
SMALL = 24
#: rows of two longs that may be broadcast: 16 MB
BROADCAST_ROWS = 1_000_000
CHECKED_TOGETHER = 128
#: share of the needed shingles that must be found in the lists, beyond one
MORE_SHARED = 0.03
#: longs of one bit for each cell that says whether a set has an odd number of shingles in it
PARITIES = 4


def overlap(n: int, m: int) -> int:
    """Fewest shared shingles of linked sets with ``n`` and ``m``: 7 * shared >= 3 * (n + m)."""
    return -(-3 * (n + m) // 7)


def partner_sizes(n: int) -> range:
    """Sizes a set linked with one of ``n`` can have."""
    return range(-(-3 * n // 4), 4 * n // 3 + 1)


def listed(n: int) -> int:
    """How many of a set's first shingles hold one of every partner's."""
    return n - -(-3 * n // 4) + 1


def subset_count(n: int) -> int:
    return sum(comb(n, overlap(n, m)) for m in partner_sizes(n))


class _Words(dict):
    def __init__(self) -> None:
        super().__init__()
        self.order: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.order)
        self.order.append(word)
        return number


class Shingler:
    """Sorted distinct shingle hashes of texts; hashes of words are remembered in a task."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.words, self.hashes = _Words(), np.empty(0, np.uint64)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        return [s for part in slices(texts, TOGETHER) for s in self._some(texts[part])]

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words.order) > REMEMBERED:
            self._forget()
        number = self.words.__getitem__
        known = len(self.words.order)
        rows = [
            np.fromiter(map(number, t.encode("utf-8", "surrogatepass").lower().split()), np.int64) for t in texts
        ]
        new = [xxhash.xxh64_intdigest(w) for w in self.words.order[known:]]
        self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return [self._shingles(self.hashes[r]) for r in rows]

    @staticmethod
    def _shingles(words: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.empty(0, np.uint64)
        size = min(WORDS, len(words))
        count = len(words) - size + 1
        mixed = np.full(count, size, np.uint64)
        for k in range(size):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _sketch(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many sets have a shingle in each cell, and how many small sets there are of each size.

    Each task counts all its texts in arrays of fixed size; pieces of them are summed by piece.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        cells, sizes = np.zeros(1 << CELL_BITS, np.int32), np.zeros(CHUNK, np.int32)
        for batch in batches:
            sets = shingler.sets(strings(batch, "text"))
            if sets:
                cells += np.bincount(_cells(np.concatenate(sets)), minlength=1 << CELL_BITS).astype(np.int32)
                lengths = np.array([len(s) for s in sets])
                sizes += np.bincount(lengths[lengths <= SMALL], minlength=CHUNK).astype(np.int32)
        pieces = np.concatenate([cells, sizes]).reshape(-1, CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(pieces), dtype=np.int32)), pa.array([p.tobytes() for p in pieces])], ["piece", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, raw in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(raw, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            ["piece", "counts"],
        )

    schema = "piece int, counts binary"
    total = docs.select("text").mapInArrow(released(count), schema).repartition("piece").mapInArrow(add, schema)
    pieces = {r["piece"]: np.frombuffer(r["counts"], np.int64) for r in total.collect()}
    last = (1 << CELL_BITS) // CHUNK
    empty = np.zeros(CHUNK, np.int64)
    cells = np.concatenate([pieces.get(i, empty) for i in range(last)])
    return np.minimum(cells, 2**31 - 1).astype(np.int32), pieces.get(last, empty)


def boundary(cells: np.ndarray, sizes: np.ndarray) -> int:
    """The largest size that is enumerated: where subsets cost less than scanning lists.

    A set of size n costs its subsets, or its list entries times the length of a typical list (from
    the sketch, less what strangers add to a cell), including for sets just below that must stay listed.
    """
    total = int(cells.sum())
    typical = float((cells.astype(np.float64) ** 2).sum()) / total - total / len(cells) if total else 1.0
    typical = max(1.0, typical)

    def cost(limit: int) -> float:
        light = sum(int(sizes[n]) * subset_count(n) for n in range(1, limit + 1))
        first = -(-3 * (limit + 1) // 4)
        return light + sum(int(sizes[n]) * listed(n) * typical for n in range(first, SMALL + 1))

    allowed = [n for n in range(SMALL + 1) if n == 0 or subset_count(n) <= MOST_SUBSETS]
    return min(allowed, key=lambda n: (cost(n), n))


@lru_cache(maxsize=64)
def _choices(n: int, size: int) -> np.ndarray:
    return np.array(list(combinations(range(n), size)), np.int64).reshape(-1, size)


def _mix(values: np.ndarray, seed: int) -> np.ndarray:
    mixed = (values ^ np.uint64(seed)) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def subset_keys(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all subsets a partner can share, and the side: 0 smaller set, 1 larger set, 2 equal."""
    n = len(shingles)
    values = _mix(shingles, 0x51)
    keys, sides = [], []
    for m in partner_sizes(n):
        chosen = values[_choices(n, overlap(n, m))].sum(axis=1, dtype=np.uint64)
        keys.append(_mix(chosen, min(n, m) * 4096 + max(n, m)))
        sides.append(np.full(len(chosen), 2 if m == n else int(m < n), np.int32))
    return np.concatenate(keys).astype(np.int64), np.concatenate(sides)


def parities(shingles: np.ndarray) -> list[int]:
    """Whether an odd number of shingles falls in each of ``64 * PARITIES`` cells.

    Two sets differ in at least as many shingles as their parities differ in cells.
    """
    cells = ((shingles >> np.uint64(20)) % np.uint64(64 * PARITIES)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def band_keys(shingles: np.ndarray) -> list[int]:
    """Keys of groups of bottom hashes, each the smallest of a part of the shingles; none of thin sets."""
    lowest = np.zeros(BINS, np.uint64)
    part = ((shingles >> np.uint64(8)) % np.uint64(BINS)).astype(np.int64)
    lowest[part[::-1]] = shingles[::-1]
    groups = lowest.reshape(BANDS, -1)
    mixed = np.arange(BANDS, dtype=np.uint64)
    for k in range(groups.shape[1]):
        mixed = _mix(mixed, k) + groups[:, k]
    return _mix(mixed, 99)[(groups > 0).all(axis=1)].astype(np.int64).tolist()


ENTRY_SCHEMA = (
    "doc_id long, n int, mark binary, centre double, bands array<long>, subsets array<long>, "
    "sides array<int>, firsts array<long>, odd array<long>"
)


@dataclass(frozen=True)
class _Order:
    """What every task needs to order shingles: the sketch and the boundary."""

    cells: np.ndarray
    limit: int


def _entries(docs: DataFrame, cells: np.ndarray, limit: int) -> DataFrame:
    """One row per document; a set's keys stand with the first document of a task that has it."""
    shared = docs.sparkSession.sparkContext.broadcast(_Order(cells, limit))
    least_listed = -(-3 * (limit + 1) // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        shingler, seen = Shingler(), set()
        for batch in batches:
            rows = []
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingler.sets(strings(batch, "text")), strict=True):
                n = len(s)
                if not n or doc_id is None:
                    rows.append((doc_id, n, *[None] * 7))
                    continue
                mark = hashlib.md5(s.tobytes()).digest()
                if mark in seen:
                    rows.append((doc_id, n, mark, *[None] * 6))
                    continue
                if len(seen) < 4 * REMEMBERED:
                    seen.add(mark)
                counts = order.cells[_cells(s)]
                subsets = sides = firsts = odd = None
                if n <= order.limit:
                    subsets, sides = subset_keys(s)
                if n >= least_listed:
                    rank = np.argsort(counts, kind="stable")
                    firsts = s[rank[: listed(n)]].astype(np.int64)
                    odd = parities(s)
                centre = float(np.log2(counts + 1.0).mean())
                rows.append((doc_id, n, mark, centre, band_keys(s), subsets, sides, firsts, odd))
            if rows:
                columns = [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    longs = pa.list_(pa.int64())
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int32()), ("mark", pa.binary()), ("centre", pa.float64()),
        ("bands", longs), ("subsets", longs), ("sides", pa.list_(pa.int32())), ("firsts", longs), ("odd", longs),
    ])
    return docs.mapInArrow(released(run), ENTRY_SCHEMA)


def _small(df: DataFrame) -> DataFrame:
    """``df``, a stored table of narrow rows, marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _subset_links(entries: DataFrame) -> DataFrame:
    """Links of sets with an equal subset: all of a key's sets with the smallest, if both sides are there."""
    keyed = entries.filter("subsets is not null").select(
        "doc_id", F.explode(F.arrays_zip("subsets", "sides")).alias("k")
    ).select("doc_id", F.col("k.subsets").alias("key"), F.col("k.sides").alias("side"))
    met = keyed.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
        F.min("side").alias("low"), F.max("side").alias("high"),
    ).filter("least <> most and (low <> high or low = 2)")
    met = store(met.select("key", "least"))
    return keyed.join(met, "key").select(F.col("doc_id").alias("a"), F.col("least").alias("b")).filter("a <> b")


def _central_pairs(entries: DataFrame) -> DataFrame:
    """Documents with the most central one of their band keys, where two keys at least agree on it."""
    banded = entries.filter("bands is not null").select("doc_id", "n", "centre", F.explode("bands").alias("band"))
    middle = banded.groupBy("band").agg(
        F.max(F.struct("centre", "doc_id", "n")).alias("mid"), F.count("*").alias("members")
    ).filter("members > 1")
    pairs = banded.join(store(middle), "band").select(
        F.col("mid.doc_id").alias("p"), F.col("doc_id").alias("d"), F.col("mid.n").alias("pn"), "n"
    )
    pairs = pairs.filter("p <> d and 4 * least(pn, n) >= 3 * greatest(pn, n)")
    return pairs.groupBy("p", "d").agg(F.count("*").alias("k")).filter("k > 1").select("p", "d")


def _listed_pairs(entries: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """Pairs of different classes that share a listed shingle and whose places allow the similarity."""
    listing = entries.filter("firsts is not null").select("doc_id", "n", "firsts", "odd", F.col("odd")[0].alias("tag"))
    named = listing.join(_small(classes), F.col("doc_id") == F.col("node"), "left")
    lists = named.select(
        "doc_id", "n", "tag", F.coalesce("component", "doc_id").alias("c"), F.posexplode("firsts").alias("place", "shingle")
    )
    mixed = lists.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
    mixed = _small(store(mixed.select("shingle")))
    # parities join the few entries that are left; texts of one id are told apart by size and first parities
    odds = store(listing.select("doc_id", "n", "tag", "odd").distinct())
    rows = lists.join(mixed, "shingle", "left_semi").join(odds, ["doc_id", "n", "tag"]).drop("tag")
    rows = store(rows.select("*", *[F.col("odd")[i].alias(f"odd{i}_") for i in range(PARITIES)]).drop("odd"))
    per_class = rows.groupBy("shingle", "c").agg(F.count("*").alias("k"))
    main = per_class.groupBy("shingle").agg(F.max(F.struct("k", "c"))["c"].alias("main"))
    left = rows.join(store(main), "shingle").filter("c <> main").select(
        "shingle", "main", *[F.col(x).alias(f"{x}1") for x in rows.columns if x != "shingle"]
    )
    # of sets that share c shingles, the first n - c + k of either share k: more than one is asked
    # for where the lists reach that far
    need = "cast(ceil(3 * (n + n1) / 7) as int)"
    reach = f"({need} - cast(ceil(3 * greatest(n, n1) / 4) as int) + 1)"
    asked = f"least({reach}, 1 + cast(ceil({MORE_SHARED} * {need}) as int))"
    apart = " + ".join(f"bit_count(odd{i}_ ^ odd{i}_1)" for i in range(PARITIES))
    met = left.join(rows, "shingle").filter(
        "c <> c1 and (c = main or doc_id1 < doc_id) and 4 * least(n, n1) >= 3 * greatest(n, n1) "
        f"and greatest(n, n1) > {limit} "
        f"and least(n - place, n1 - place1) > {need} - {asked} and {apart} <= n + n1 - 2 * {need}"
    )
    # a shared shingle appears once for a pair, on whichever side it is outside the main class; ids with
    # several texts count the entries of all, so the least asked of any of them is asked
    pair = met.select(
        F.least("doc_id1", "doc_id").alias("p"), F.greatest("doc_id1", "doc_id").alias("d"), F.expr(asked).alias("asked")
    ).groupBy("p", "d").agg(F.count("*").alias("k"), F.min("asked").alias("asked"))
    return pair.filter("k >= asked").select("p", "d")


def _checked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links (a, b) among ``pairs`` (p, d), by counting shared shingles.

    Sets of the documents named by a pair are made once. A document p meets its partners in runs of
    bounded length that different tasks can take; only p's set is held. The links are stored, the sets deleted.
    """
    pairs = store(pairs)
    named = pairs.select(F.col("p").alias("doc_id")).unionByName(pairs.select(F.col("d").alias("doc_id")))
    named = _small(store(named.distinct()))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = [s.tobytes() for s in shingler.sets(strings(batch, "text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"]
            )

    sets = store(docs.join(named, "doc_id", "left_semi").mapInArrow(released(make), "doc_id long, shingles binary"))
    spread = pairs.groupBy("p").agg(F.ceil(F.count("*") / CHECKED_TOGETHER).cast("int").alias("runs"))
    cut = pairs.join(store(spread), "p").select(
        "p", "d", F.pmod(F.xxhash64("d"), F.col("runs")).cast("int").alias("run")
    )
    cut = store(cut)
    heads = cut.select("p", "run").distinct().join(sets, F.col("p") == F.col("doc_id"))
    tails = cut.join(sets, F.col("d") == F.col("doc_id"))
    columns = ["p", "run", "doc_id", "shingles"]
    rows = heads.select(*columns, F.lit(0).alias("tail")).unionByName(tails.select(*columns, F.lit(1).alias("tail")))
    rows = rows.repartition("p", "run").sortWithinPartitions("p", "run", "tail")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list[np.ndarray] = []
        current = None
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("p", "run", "doc_id", "shingles", "tail"))
            for p, run, d, raw, tail in zip(*columns, strict=True):
                own = np.frombuffer(raw, np.uint64)
                if not tail:
                    if current != (p, run):
                        head, current = [], (p, run)
                    head.append(own)  # one, or one for each text of a repeated id
                    continue
                for other in head:
                    small, large = (own, other) if len(own) < len(other) else (other, own)
                    at = np.searchsorted(large, small)
                    at[at == len(large)] = 0
                    shared = int((large[at] == small).sum()) if len(large) else 0
                    if 7 * shared >= 3 * (len(small) + len(large)) and len(small):
                        found.append((p, d))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"]
                )

    links = store(rows.mapInArrow(released(check), "a long, b long"))
    discard(sets)
    return links


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles`` and ``component_id``, the class's smallest key."""
    source = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    cells, sizes = _sketch(source)
    limit = boundary(cells, sizes)
    entries = store(_entries(source, cells, limit))
    marked = entries.filter("mark is not null").select("doc_id", "mark")
    firsts = marked.groupBy("mark").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("most"))
    firsts = store(firsts.filter("b <> most"))
    equal = marked.join(firsts, "mark").select(F.col("doc_id").alias("a"), "b").filter("a <> b")
    early = store(
        equal.unionByName(_subset_links(entries)).unionByName(_checked(source, _central_pairs(entries)))
    )
    classes = store(components(early))
    late = _checked(source, _listed_pairs(entries, classes, limit))
    # classes of classes: late links between the early classes' smallest documents
    names = classes.select("node", "component")
    lifted = late
    for side in ("a", "b"):
        lifted = lifted.join(names.withColumnRenamed("node", side), side, "left").withColumn(
            side, F.coalesce("component", side)
        ).drop("component")
    joined = components(lifted).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    linked = classes.select("node", "component").unionByName(
        lifted.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .join(classes.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    )
    final = linked.join(joined, "component", "left").select(
        F.col("node").alias("doc_id"), F.coalesce("whole", "component").alias("component_id")
    )
    out = entries.select("doc_id", "n").join(final, "doc_id", "left")
    return out.select(
        F.col("doc_id").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
