from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankscope.llm import source_divergence as sd

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least):
    """The audit by plain loops over ``(text, lang, source)``."""
    rows = [(t or "", a or "", b or "") for t, a, b in rows]
    found = [Counter(w.translate(LOWER) for w in re.findall(sd.TERM, t)) for t, _, _ in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        mine = [(r[2], c) for r, c in zip(rows, found, strict=True) if r[1] == lang]
        held = Counter(w for _, c in mine for w in c)
        kept = [w for w in held if held[w] >= least]
        counts = defaultdict(Counter)
        for source, c in mine:
            counts[source].update({w: c[w] for w in kept if w in c})
            counts[None].update({w: c[w] for w in kept if w in c})

        def p(group, w, counts=counts, kept=kept):
            return 1 + 10**9 * (counts[group][w] + 2) // (sum(counts[group].values()) + 2 * len(kept))

        def gap(x, y):
            return (x - y) ** 2 // (x + y)

        sources = {s for s, _ in mine}
        for s in sources:
            pairs = [(-sum(gap(p(s, w), p(o, w)) for w in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-gap(p(s, w), p(None, w)), w.encode(), w) for w in kept if counts[s][w] and p(s, w) > p(None, w)]
            for part, found_, most in (("pair", pairs, None), ("term", terms, sd.BEST_TERMS)):
                for rank, (value, _, item) in enumerate(sorted(found_)[:most], 1):
                    out.add((lang, s, part, item, -value, rank))
    return out


def audited(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "text string, lang string, source string, n long, term string, docs string")
    found = [tuple(r) for r in sd.audit(docs.repartition(3), **settings).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_equals_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(5)
    words = ["Alpha", "alpha", "ALPHA,", "be-ta", "beta.", "ÄÖ", "äö", "12", "x1y", "été", "日本", "a b", "z" * 90, "Q" * 70 + "-q", "—"]
    rows = [(None, None, None), ("", "en", "only empty"), (None, "xx", "alone"), ("12 !!", "yy", "b"), ("", "yy", "a")]
    for i in range(120):
        text = " \t\n"[i % 3].join(rng.choice(words, rng.integers(1, 40)))
        rows.append((text, ["en", "de", None, ""][i % 4], ["s1", "s2", None, "", "é", "S1"][rng.integers(0, 6)]))
    rows += [("the same words", "en", "s1")] * 30 + [("word " * 5000, "en", "s2")]
    full = [(*r, 1, "t", "d") for r in rows]
    assert audited(spark, full, least_docs=3, held_rows=40) == brute(rows, 3)


def test_more_sources_than_a_span(spark):
    rows = [(f"w{'abcdefg'[i % 7]} common w{'xyz'[i % 3]}", "en", f"s{i}") for i in range(sd.SPAN + 14)] * 2
    rows += [("wa", "de", f"s{i}") for i in range(3)]
    found = audited(spark, [(*r, 0, "", "") for r in rows], least_docs=4)
    assert found == brute(rows, 4)


def test_empty_table_and_no_terms(spark):
    assert audited(spark, []) == set()
    assert audited(spark, [("a b", "en", "x", 1, "", ""), ("c", "en", "y", 1, "", "")]) == {
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)
    }


def test_matrix_equals_loops():
    rng = np.random.default_rng(2)
    number = np.concatenate([np.arange(3), [256, 257], rng.permutation(np.tile([0, 1, 2, 256, 257], 8))[:20]])
    code = np.concatenate([np.zeros(5, int), np.repeat(np.arange(1, 11), 2)])
    keep = np.unique(np.stack([number, code]), axis=1, return_index=True)[1]
    number, code = number[keep], code[keep]
    p = rng.integers(1, 10**9 + 2, len(number))
    absent = code == 0
    value = {(n, c): x for n, c, x in zip(number, code, p, strict=True)}
    sums, seen = sd._matrix(number, p, code, absent, 0, 1)
    used = set(code) - {0}
    for a in range(3):
        for b in range(2):
            pairs = [(int(value.get((a, c), value[a, 0])), int(value.get((256 + b, c), value[256 + b, 0]))) for c in used]
            assert sums[a, b] == sum((x - y) ** 2 // (x + y) for x, y in pairs)
    assert seen == len(used)


@pytest.mark.parametrize("held", [1, 10**9])
def test_chunks_are_counted_whole(spark, held):
    rows = [(f"w{i % 3} same same", "en", f"s{i % 2}") for i in range(40)] + [("same", "de", "s1"), (None, None, None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    cut = {r.chunk: r for r in sd.cut_chunks(docs.repartition(4), held).collect()}
    assert sorted(cut) == ["same", "w0", "w1", "w2"] and cut["w0"].terms == ["w"]
    found = {f.lang: (f.docs, {c.source: c.n for c in f.cells}) for f in cut["same"].found}
    assert found == {"en": (40, {"s0": 40, "s1": 40}), "de": (1, {"s1": 1})}


@pytest.mark.parametrize("bits", [1 << 16, 1 << 25])
def test_filter_passes_all_that_it_holds_and_little_else(spark, bits):
    held = spark.createDataFrame([(f"held{i}",) for i in range(500)], "chunk string")
    docs = spark.createDataFrame([(f"held{i} other{i} held{i}", "en") for i in range(500)], "text string, lang string")
    found = sd.chunk_documents(docs.repartition(3), sd.chunk_filter(held, bits), bits).collect()
    mine = [r for r in found if r.chunk.startswith("held")]
    assert len({r.doc for r in mine}) == len(mine) == 500 and len(found) < 520


def test_documents_of_several_chunks_count_once(spark):
    # each chunk is in fewer documents than are needed; together four and three
    rows = [("Aa aa", "en", "x"), ("aa. AA", "en", "x"), ("(aa)", "en", "y"), ("aa!", "en", "y")]
    rows += [("Bb bb", "en", "x"), ("bb. BB", "en", "x"), ("(bb)", "en", "y")] + [("cc", "en", "x")] * 4
    found = audited(spark, [(*r, 0, "", "") for r in rows], least_docs=4)
    assert found == brute(rows, 4) and {r[3] for r in found if r[2] == "term"} == {"aa", "cc"}


def test_digests_follow_the_bytes_alone():
    words = ["", "a", "a\0", "\0a", "ab" * 4, "ab" * 4 + "a", "é", "日本" * 9, "x" * 64, " " + "f" * 64, *(f"w{i}" for i in range(5000))]
    chunks = pa.array(words)
    digests = sd._digests(chunks)
    assert len(set(digests.tolist())) == len(words)
    assert (sd._digests(chunks[3:40]) == digests[3:40]).all()  # wherever a text lies
    assert (sd._digests(pa.array(words[::-1]))[::-1] == digests).all()
    assert len(sd._digests(pa.array([], pa.string()))) == 0


def test_counts_carry_codes_not_texts():
    """No chunk is copied for each place that has it, and dictionaries of several slices meet in one."""
    one = sd._counted(["b a b", "a"], ["en", None], ["s", "s"])
    two = sd._counted(["c b", None], ["en", "en"], ["t", "s"])
    assert all(pa.types.is_dictionary(one.schema.field(c).type) for c in ("lang", "source", "chunk"))
    rows = {(r["lang"], r["chunk"]): (r["docs"], dict(zip(r["sources"], r["counts"], strict=True))) for r in sd._packed([one, two]).to_pylist()}
    assert rows == {("en", "b"): (2, {"s": 2, "t": 1}), ("en", "a"): (1, {"s": 1}), ("", "a"): (1, {"s": 1}), ("en", "c"): (1, {"t": 1})}


def test_probability_is_exact_on_both_sides_of_a_long(spark):
    cases = [(0, 0, 0), (0, 5, 3), (7, 10**12 + 7, 11), (sd.MOST_SHORT - 1, sd.MOST_SHORT, 1), (sd.MOST_SHORT, 10**15, 2), (10**15, 10**15, 2)]
    rows = spark.createDataFrame(cases, "n long, total long, kept long").select("n", "total", "kept", sd._probability(F.col("n")).alias("p"))
    assert {tuple(r) for r in rows.collect()} == {(n, t, k, 1 + 10**9 * (n + 2) // (t + 2 * k) if k else 1) for n, t, k in cases}


def test_terms_are_cut_once_a_chunk(spark):
    docs = spark.createDataFrame([("12 a1b -- " + "9" * 70, "en", "s"), ("é !! " + "-" * 70 + "x", "en", "t")], "text string, lang string, source string")
    cut = sd.cut_chunks(docs)
    assert {tuple(r.terms) for r in cut.collect()} == {("a", "b"), ("é",), ("x",)}
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
