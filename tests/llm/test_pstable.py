from __future__ import annotations

import numpy as np
import pytest
from tables import TINY

from rankscope.llm import pstable
from rankscope.llm.queries import near_vectors


def brute(rows, cosine=0.95):
    """n_links and component by comparing all rows."""
    usable, unit = [], []
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.append(i)
            unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [set() for _ in rows]
    for a, i in enumerate(usable):
        for b, j in enumerate(usable):
            if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[i].add(j)
    component = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            least = min([component[i], *(component[j] for j in near)])
            changed |= least != component[i]
            component[i] = least
    return [(r[0], len(near), c) for r, near, c in zip(rows, links, component, strict=True)]


def test_query_against_all_pairs(spark):
    table = spark.read.parquet(f"{TINY}/embeddings.parquet").collect()
    expected = {e[0]: e for e in brute([(r.vec_id, r.embedding) for r in table])}
    rows = near_vectors(spark, TINY).collect()
    assert len(rows) == len(table)
    found, wanted = sum(r.n_links for r in rows), sum(e[1] for e in expected.values())
    assert 0.9 * wanted <= found <= wanted
    assert np.mean([r.component_id == expected[r.vec_id][2] for r in rows]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


@pytest.mark.parametrize("block", [512, 16])
def test_groups_larger_than_a_block(spark, monkeypatch, block):
    monkeypatch.setattr(pstable, "BLOCK", block)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.02).tolist()) for i in range(90)]
    rows += [(100 + i, rng.normal(size=16).tolist()) for i in range(60)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # copies
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in pstable.near_vectors(docs, recall=0.9999).collect())
    assert got == sorted(brute(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2),
        (7, [1.0, 0.0], 3), (8, [2.0, 0.0], 3), (9, [1.0, 0.0, 0.0], 3), (10, [1.0, -0.0], None), (10, [1.0, 0.0], None),
    ]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links long")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in pstable.near_vectors(docs).collect())
    assert got == sorted(brute([r[:2] for r in rows]))
    assert pstable.near_vectors(docs.limit(0)).count() == 0
