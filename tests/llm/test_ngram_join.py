from __future__ import annotations

import random

import numpy as np
import pytest
from tables import TINY

from rankscope.llm import ngram_join
from rankscope.llm.components import components
from rankscope.llm.queries import near_texts


def brute(rows):
    """Set size and class of each row by comparing all sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    component = [r[0] for r in rows]
    links = [
        [j for j in range(len(rows)) if i != j and sets[i] and sets[j]
         and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        for i in range(len(rows))
    ]
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            least = min([component[i], *(component[j] for j in near)])
            changed |= least != component[i]
            component[i] = least
    return sorted((r[0], len(s), c) for r, s, c in zip(rows, sets, component, strict=True))


def found(spark, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return sorted(map(tuple, ngram_join.near_classes(docs).collect()))


def test_query_against_all_pairs(spark, tiny_docs):
    got = sorted(map(tuple, near_texts(spark, TINY).collect()))
    assert got == brute(list(zip(tiny_docs.doc_id, tiny_docs.text, strict=True)))


def variants(seed: int, count: int, low: int, high: int):
    """Texts with words replaced here and there, on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        if i % 12 == 0:
            base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(low, high))]
        text = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            at = rng.randrange(len(text))
            text[at : at + 1] = [] if rng.random() < 0.3 and len(text) > 1 else [f"v{rng.randrange(10**6)}"]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize(("low", "high"), [(1, 14), (8, 30), (60, 200)])
def test_edited_texts(spark, low, high):
    rows = variants(low, 240, low, high)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("limit", [0, 6, 12])
def test_any_boundary_gives_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "boundary", lambda cells, sizes: limit)
    rows = variants(77, 240, 4, 24)
    assert found(spark, rows) == brute(rows)


def test_shared_passage_and_large_groups(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(80)]
    rows = []
    for i in range(300):
        if i % 3 == 0:
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(80)] = word()
        elif i % 3 == 1:
            text = passage + [word() for _ in range(rng.randint(5, 120))]
        else:
            text = base if i % 2 else [word() for _ in range(40)]
        rows.append((i, " ".join(text)))
    assert found(spark, rows) == brute(rows)


def test_equality_at_the_threshold(spark):
    # 12 and 9 shingles, 9 shared: exactly 0.75
    words = [f"w{i}" for i in range(16)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:13])), (3, " ".join(words[:12]))]
    assert [r[2] for r in found(spark, rows)] == [1, 1, 1]
    assert [r[2] for r in found(spark, [rows[0], rows[2]])] == [1, 3]


def test_odd_rows(spark, odd_docs):
    rows = ngram_join.near_classes(odd_docs.withColumnRenamed("row", "n_shingles")).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_shingles == 0 and by_id[1].component_id == 1 and by_id[2].component_id == 2
    assert by_id[5].component_id == 4 and by_id[None].component_id is None and by_id[None].n_shingles == 1
    assert ngram_join.near_classes(odd_docs.limit(0)).count() == 0


def test_costs():
    assert all(7 * ngram_join.overlap(n, m) >= 3 * (n + m) for n in range(1, 40) for m in range(1, 40))
    assert ngram_join.boundary(np.ones(16, np.int32), np.zeros(4096, np.int64)) == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(5000 + i, 5000 + rng.randrange(50)) for i in range(50)] + [(None, 3), (7, 7)]
    rng.shuffle(edges)
    roots = {x: x for e in edges for x in e if x is not None}

    def root(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = root(a), root(b)
            roots[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in linked)


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 2**63, rng.integers(2, 900)).astype(np.uint64)
        one, two = (np.unique(pool[rng.random(len(pool)) < rng.random()]) for _ in range(2))
        pairs = zip(ngram_join.parities(one), ngram_join.parities(two), strict=True)
        assert sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in pairs) <= len(np.setxor1d(one, two))


def test_an_id_with_several_texts_keeps_the_links_of_each(spark):
    rng = random.Random(21)
    long, other = ([f"{x}{rng.randrange(10**6)}" for _ in range(n)] for x, n in (("a", 300), ("b", 40)))
    near = [*long[:150], "x", *long[151:]]
    short = [*other[:20], "y", *other[21:], "z"]
    rows = [(5, " ".join(long)), (5, " ".join(other)), (2, " ".join(near)), (3, " ".join(other)), (9, " ".join(short))]
    got = {(i, n): c for i, n, c in found(spark, rows)}
    assert {got[5, 296], got[5, 36], got[2, 296], got[3, 36]} == {2}
