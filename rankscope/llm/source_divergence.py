"""How far the sources of a language differ in their words, by chunk factorization.

White space cuts a text into chunks. A task counts the chunks of its documents, by language and source, and
how many documents hold each. The counts are added up by chunk, so that each distinct chunk of the corpus is
one row with the sources that have it; it is cut into terms there, once, and its counts go to its terms.

Whether a term is kept depends on its distinct documents, and a document may hold a term in several chunks
("Word", "word,"). The largest count of one chunk and the sum over all chunks bound the number. Where the
bounds leave it open, each such chunk is in fewer than ``LEAST_DOCS`` documents: a second pass lists the documents
of these few chunks, found through a bit filter of at most ``MOST_BITS`` bits, and counts distinct ones.

Terms are runs of ASCII letters and characters beyond ASCII, with A to Z lower-cased. A language keeps the
terms that at least ``LEAST_DOCS`` of its documents hold. NULL text, language and source count as empty,
an empty text has no terms, every row is a document of its own (repeated ids and rows too). Texts of any
length are cut whole; a chunk longer than ``LONGEST_KEY`` is known by its SHA-256. Equal values rank by
the UTF-8 bytes of the item. A language that keeps no term has pairs of value 0 and no terms. An empty table
gives no rows. Extra columns are ignored.

Pairs: every source of a language is compared with every other, as asked. Sources are taken in spans of
``SPAN``; a task adds up a part of the terms for two spans in a matrix, so memory follows the span and
the part, not the number of sources or terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankscope.llm.common import released, runs, slices, store

LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
TERM = f"{LETTER}+"
LEAST_DOCS = 10
BEST_TERMS = 10
#: characters of texts that are cut in one go, and rows that a task holds before it hands them on
SLICE_CHARS = 2_000_000
HELD_ROWS = 1_000_000
LONGEST_KEY = 64
SPAN = 256
PART_ROWS = 500_000
CELLS = 2_000_000
#: terms that a join broadcasts, after they were counted
BROADCAST_ROWS = 1_000_000
SALTS = 16
PER = 1_000_000_000
#: counts below this, times ``PER``, fit a long
MOST_SHORT = 9_000_000_000
MOST_BITS = 1 << 28

_ROW = "lang string, chunk string, whole string, docs long, sources array<string>, counts array<long>"


def _keys(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Join keys of chunks, and the chunk where its key is a digest. No chunk holds a space."""
    if not len(chunks) or pc.max(pc.binary_length(chunks)).as_py() <= LONGEST_KEY:
        return chunks, pa.nulls(len(chunks), pa.string())
    texts = chunks.to_pylist()
    raw = [t.encode() for t in texts]
    keys = [t if len(r) <= LONGEST_KEY else " " + hashlib.sha256(r).hexdigest() for t, r in zip(texts, raw, strict=True)]
    whole = [t if len(r) > LONGEST_KEY else None for t, r in zip(texts, raw, strict=True)]
    return pa.array(keys, pa.string()), pa.array(whole, pa.string())


def _cut(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Chunks of texts: the text and the distinct chunk of each, the distinct chunks' keys, and the long ones whole."""
    cut = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.string()))
    text = pc.list_parent_indices(cut).to_numpy().astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    chunk = coded.indices.to_numpy().astype(np.int64)
    filled = np.flatnonzero(pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[chunk])
    return text[filled], chunk[filled], *_keys(coded.dictionary)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _counted(texts: list[str | None], langs: list[str | None], sources: list[str | None]) -> pa.Table:
    """Occurrences and documents of each chunk by language and source, these three as codes of dictionaries."""
    pairs: dict[tuple[str, str], int] = {}
    group = np.array([pairs.setdefault((a or "", b or ""), len(pairs)) for a, b in zip(langs, sources, strict=True)], np.int64)
    text, chunk, keys, whole = _cut(texts)
    # by chunk, then group, then document
    place, times = np.unique((chunk * len(pairs) + group[text]) * len(texts) + text, return_counts=True)
    cell = place // len(texts)
    starts = _starts(cell)
    at, pair = pa.array(cell[starts] // len(pairs)), pa.array(cell[starts] % len(pairs))
    named = [pa.array([p[k] for p in pairs], pa.string()).dictionary_encode().take(pair) for k in (0, 1)]
    coded = pa.DictionaryArray.from_arrays(at.cast(pa.int32()), keys)
    n = np.add.reduceat(times, starts) if len(starts) else np.zeros(0, np.int64)
    docs = np.diff(np.append(starts, len(cell)))
    return pa.table([*named, coded, whole.take(at), pa.array(n), pa.array(docs)], ["lang", "source", "chunk", "whole", "n", "docs"])


def _packed(tables: list[pa.Table]) -> pa.RecordBatch:
    """The counts of several tables added up: one row for each language and chunk, its sources in lists."""
    table = pa.concat_tables(tables).unify_dictionaries()
    codes, names = {}, {}
    for name in ("lang", "source", "chunk"):
        column = table.column(name).combine_chunks()
        codes[name], names[name] = column.indices.to_numpy().astype(np.int64), column.dictionary
    langs, sources = max(1, len(names["lang"])), max(1, len(names["source"]))
    row = codes["chunk"] * langs + codes["lang"]
    order = np.argsort(row * sources + codes["source"], kind="stable")
    row, source = row[order], codes["source"][order]
    cells = _starts(row * sources + source)
    heads = _starts(row[cells])
    n, docs = (table.column(c).to_numpy()[order] for c in ("n", "docs"))
    if len(cells):
        n = np.add.reduceat(n, cells)
        docs = np.add.reduceat(docs, cells[heads])
    bounds = pa.array(np.append(heads, len(cells)).astype(np.int32))
    first = row[cells[heads]]
    return pa.RecordBatch.from_arrays(
        [
            names["lang"].take(pa.array(first % langs)), names["chunk"].take(pa.array(first // langs)),
            table.column("whole").combine_chunks().take(pa.array(order[cells[heads]])), pa.array(docs),
            pa.ListArray.from_arrays(bounds, names["source"].take(pa.array(source[cells]))),
            pa.ListArray.from_arrays(bounds, pa.array(n)),
        ],
        ["lang", "chunk", "whole", "docs", "sources", "counts"],
    )


def chunk_rows(docs: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """One row for each task, language and chunk: its documents, and its occurrences by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("text", "lang", "source")]
            for part in slices(columns[0], SLICE_CHARS):
                held.append(_counted(*[c[part] for c in columns]))
                if sum(len(t) for t in held) >= held_rows:
                    yield _packed(held)
                    held = []
        if held:
            yield _packed(held)

    return docs.select("text", "lang", "source").mapInArrow(released(run), _ROW)


def lowered(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def cut_chunks(docs: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """A row for each distinct chunk: its ``terms``, and ``found`` with its documents and sources by language.

    One shuffle by chunk; a chunk comes from a task once, and what is collected is bounded by the sources.
    """
    text, cells = F.coalesce("whole", "chunk"), F.arrays_zip("sources", "counts")
    # a filter on the terms would cut each task's chunks before the shuffle; one that looks for a letter is cheap there
    lettered = chunk_rows(docs, held_rows).filter(text.rlike(LETTER))
    apart = lettered.repartition("chunk").select("*", F.posexplode(cells).alias("place", "cell"))
    # a chunk's long form is a key, not an aggregate, so that the sums stay in a hash table
    by_source = apart.groupBy("chunk", "whole", "lang", F.col("cell.sources").alias("source")).agg(
        F.sum("cell.counts").alias("n"), F.sum(F.when(F.col("place") == 0, F.col("docs")).otherwise(0)).alias("docs")
    )
    by_lang = by_source.groupBy("chunk", "whole", "lang").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    whole = by_lang.groupBy("chunk", "whole").agg(F.collect_list(F.struct("lang", "docs", "n", "cells")).alias("found"))
    return whole.select("chunk", F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1)).alias("terms"), "found")


def _by_term(cut: DataFrame) -> DataFrame:
    """``(lang, term, chunk, docs, n, cells)``, a row for each time that a chunk holds a term."""
    rows = cut.select("chunk", "terms", F.inline("found"))
    each = rows.select("lang", F.explode("terms").alias("term"), "chunk", "docs", "n", "cells")
    return each.withColumn("term", lowered(F.col("term")))


def _digests(chunks: pa.Array) -> np.ndarray:
    """A 64-bit hash of each chunk, eight bytes of all chunks in a step. Keys are short, so steps are few."""
    texts = chunks.cast(pa.large_string())
    _, bounds, data = texts.buffers()
    ends = np.frombuffer(bounds or bytes(8), np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, length = ends[:-1], np.diff(ends)
    padded = np.append(np.frombuffer(data or b"", np.uint8), np.zeros(8, np.uint8))
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    digest = length.astype(np.uint64)
    for start in range(0, int(length.max(initial=0)), 8):
        at = np.flatnonzero(length > start)
        unused = 8 * (8 - np.minimum(length[at] - start, 8)).astype(np.uint64)
        mixed = (digest[at] ^ (words[first[at] + start] << unused)) * np.uint64(0x9E3779B97F4A7C15)
        digest[at] = mixed ^ (mixed >> np.uint64(29))
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        digest = (digest ^ (digest >> np.uint64(32))) * np.uint64(factor)
    return digest ^ (digest >> np.uint64(32))


def _positions(chunks: pa.Array, bits: int) -> np.ndarray:
    """Two places in the filter for each chunk."""
    digests = _digests(chunks)
    return np.stack([digests, (digests >> np.uint64(32)) | (digests << np.uint64(32))]) % np.uint64(bits)


def chunk_filter(chunks: DataFrame, bits: int) -> np.ndarray:
    """A bit for each place of the distinct ``chunk`` values, as bytes. Tasks send words of 32 bits that are not 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_positions(batch.column("chunk"), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places // 32), pa.array(1 << (places % 32))], ["word", "bits"])

    words = chunks.select("chunk").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(bits // 32, "<u4")
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return np.unpackbits(filled.view(np.uint8), bitorder="little") if bits <= 1 << 24 else filled.view(np.uint8)


def chunk_documents(docs: DataFrame, filled: np.ndarray, bits: int) -> DataFrame:
    """``(lang, chunk, doc)`` of the chunks whose places in the filter are set; ``doc`` numbers the rows."""

    def passes(chunks: pa.Array) -> np.ndarray:
        places = _positions(chunks, bits).astype(np.int64)
        if len(filled) == bits:
            return filled[places].all(axis=0)
        return ((filled[places // 8] >> (places % 8).astype(np.uint8)) & 1).all(axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for part in slices(texts, SLICE_CHARS):
                text, chunk, keys, _ = _cut(texts[part])
                wanted = np.flatnonzero(passes(keys)[chunk]) if len(chunk) else np.zeros(0, np.int64)
                many = max(1, len(keys))
                text, chunk = np.divmod(np.unique(text[wanted] * many + chunk[wanted]), many)
                lang = pa.array([x or "" for x in langs[part]], pa.string()).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([lang, keys.take(pa.array(chunk)), pa.array(text + first)], ["lang", "chunk", "doc"])
                first += part.stop - part.start

    return docs.select("text", "lang").mapInArrow(released(run), "lang string, chunk string, doc long")


def kept_terms(docs: DataFrame, cut: DataFrame, least_docs: int) -> DataFrame:
    """``(lang, term, lang_n)`` of the terms that enough documents of the language hold."""
    bounds = _by_term(cut).groupBy("lang", "term").agg(
        F.max("docs").alias("least"), F.sum("docs").alias("most"), F.sum("n").alias("lang_n")
    )
    likely = store(bounds.filter(F.col("most") >= least_docs))
    sure = likely.filter(F.col("least") >= least_docs).select("lang", "term", "lang_n")
    doubtful = likely.filter(F.col("least") < least_docs).select("lang", "term", "lang_n")
    open_terms = doubtful.count()
    if not open_terms:
        return sure
    few = F.broadcast(doubtful) if open_terms <= BROADCAST_ROWS else doubtful
    # all chunks of such a term are in few documents; a chunk may hold it several times
    of_chunk = store(_by_term(cut).select("lang", "term", "chunk").join(few, ["lang", "term"]).distinct())
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(16, (32 * of_chunk.count()).bit_length()))
    listed = store(chunk_documents(docs, chunk_filter(of_chunk, bits), bits))
    held = of_chunk.join(listed, ["lang", "chunk"]).groupBy("lang", "term", "lang_n", "doc").count()
    enough = held.groupBy("lang", "term", "lang_n").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs)
    return sure.unionByName(enough.select("lang", "term", "lang_n"))


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, held_rows: int = HELD_ROWS) -> DataFrame:
    """``(lang, source, term, n, lang_n)`` of the kept terms where a source has them."""
    cut = store(cut_chunks(docs, held_rows))
    kept = store(kept_terms(docs, cut, least_docs))
    rows, keys = _by_term(cut).drop("docs", "n"), ["lang", "term"]
    if kept.count() <= BROADCAST_ROWS:
        kept = F.broadcast(kept)
    else:
        # a term in very many chunks is spread, and added up in its tasks before the last shuffle
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(SALTS)).cast("int"))
        kept, keys = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"]
    found = rows.join(kept, keys).select("lang", "term", "lang_n", F.inline("cells"))
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.max("lang_n").alias("lang_n"))


def _probability(n: Column) -> Column:
    """``1 + floor(10^9 (n + 2) / (total + 2 kept))``, in decimals where a long is too short; 1 where the language keeps no term."""
    whole = F.col("total") + 2 * F.col("kept")
    short = F.call_function("div", F.lit(PER).cast("long") * (n + 2), whole)
    part = F.lit(PER).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    long = F.call_function("div", part, whole.cast("decimal(20,0)"))
    return F.when(F.col("kept") > 0, 1 + F.when(n < MOST_SHORT, short).otherwise(long)).otherwise(1).cast("long")


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _span_pairs(entries: DataFrame) -> DataFrame:
    """``(lang, a, b, gaps, seen)`` of sources ``a < b``: the sum over the terms of a part, and their number.

    ``entries`` has ``lang``, the source's ``number``, ``term``, ``p``, and how many ``spans`` and ``parts`` the
    language has. The row of an empty term gives a source's ``p`` where a term is absent, for every part.
    """
    own = F.floor(F.col("number") / SPAN).cast("int")
    parts = F.when(F.col("term") == "", F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    )
    spread = (
        entries.withColumn("part", F.explode(parts))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("spans") - 1)))
        .select("lang", F.least("other", own).alias("low"), F.greatest("other", own).alias("high"), "part", "number", "term", "p")
    )
    keys = ["lang", "low", "high", "part"]
    sorted_rows = spread.repartition(*keys).sortWithinPartitions(*keys, "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, keys):
            low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
            number, p = rows.column("number").to_numpy(), rows.column("p").to_numpy()
            term = rows.column("term").combine_chunks().dictionary_encode()
            code = term.indices.to_numpy()
            absent = code == code[0]  # the empty term is the first of its run
            sums, seen = _matrix(number, p, code, absent, low, high)
            left, right = (np.unique(number[absent & (number // SPAN == s)]) for s in (low, high))
            at = np.flatnonzero((left[:, None] < right[None, :]).ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows.column("lang")[0].as_py()] * len(at), pa.string()), pa.array(np.repeat(left, len(right))[at]),
                 pa.array(np.tile(right, len(left))[at]), pa.array(sums.ravel()[at]), pa.array(np.full(len(at), seen, np.int64))],
                ["lang", "a", "b", "gaps", "seen"],
            )

    return sorted_rows.mapInArrow(released(run), "lang string, a int, b int, gaps long, seen long")


def _matrix(
    number: np.ndarray, p: np.ndarray, code: np.ndarray, absent: np.ndarray, low: int, high: int
) -> tuple[np.ndarray, int]:
    """The sums of gaps between the sources of two spans, and the number of terms; ``code`` tells terms apart."""
    sides = []
    for span in (low, high):
        mine = number // SPAN == span
        base = np.zeros(number[mine & absent].max() % SPAN + 1, np.int64)
        base[number[mine & absent] % SPAN] = p[mine & absent]
        sides.append((base, mine & ~absent))
    used, term = np.unique(code[~absent], return_inverse=True)
    terms = np.zeros(len(code), np.int64)
    terms[~absent] = term
    sums = np.zeros((len(sides[0][0]), len(sides[1][0])), np.int64)
    step = max(1, CELLS // sums.size)
    for start in range(0, len(used), step):
        many = min(step, len(used) - start)
        filled = []
        for base, mine in sides:
            here = mine & (terms >= start) & (terms < start + many)
            values = np.tile(base, (many, 1))
            values[terms[here] - start, number[here] % SPAN] = p[here]
            filled.append(values)
        one, two = filled[0][:, :, None], filled[1][:, None, :]
        sums += ((one - two) ** 2 // (one + two)).sum(axis=0)
    return sums, len(used)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, held_rows: int = HELD_ROWS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: each group against its language's other sources and all of it."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    kept = store(term_counts(docs, least_docs, held_rows))

    # a row for each group; a language has as many rows here as it has sources
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("n").alias("lang_total")
    )
    of_lang = Window.partitionBy("lang")
    groups = store(
        docs.select(*names).distinct()
        .join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("number", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int"))
        .withColumn("sources", F.count("*").over(of_lang))
        .withColumn("spans", F.ceil(F.col("sources") / SPAN).cast("int"))
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / PART_ROWS)).cast("int"))
        .withColumn("absent", _probability(F.lit(0)))
    )
    counted = kept.join(groups, ["lang", "source"]).withColumn("p", _probability(F.col("n")))

    all_n = counted.withColumn("total", F.col("lang_total")).withColumn("q", _probability(F.col("lang_n")))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        all_n.filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= BEST_TERMS)
    )

    shape = ["lang", "number", "term", "p", "spans", "parts"]
    entries = counted.select(*shape).unionByName(
        groups.filter("sources > 1").select("lang", "number", F.lit("").alias("term"), F.col("absent").alias("p"), "spans", "parts")
    )
    several = groups.filter("sources > 1").select("lang").distinct()
    sums = _span_pairs(entries.join(several, "lang", "left_semi")).groupBy("lang", "a", "b").agg(
        F.sum("gaps").alias("gaps"), F.sum("seen").alias("seen")
    )
    one, two = (
        groups.select("lang", F.col("number").alias(k), F.col("source").alias(f"source_{k}"), F.col("absent").alias(f"p_{k}"), *more)
        for k, more in (("a", ["kept"]), ("b", []))
    )
    between = sums.join(one, ["lang", "a"]).join(two, ["lang", "b"]).withColumn(
        "value", F.col("gaps") + (F.col("kept") - F.col("seen")) * _gap(F.col("p_a"), F.col("p_b"))
    )
    sides = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
    )
    pairs = between.select("lang", "value", F.inline(sides)).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    ).withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)
