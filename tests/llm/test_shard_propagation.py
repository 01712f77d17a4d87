from __future__ import annotations

import zlib
from collections import Counter

from tables import TINY

from rankscope.llm.queries import propagated_shards
from rankscope.llm.shard_propagation import shard_texts


def check_law(rows, shards=8):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_query_obeys_the_law(spark, tiny_docs):
    rows = propagated_shards(spark, TINY).collect()
    assert Counter(r.doc_id for r in rows) == Counter(tiny_docs.doc_id)
    check_law(rows)
    texts = dict(zip(tiny_docs.doc_id, tiny_docs.text, strict=True))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_copies_stay_together(spark):
    # a group of a tenth of all rows, many pairs, and texts of their own
    texts = ["hot"] * 100 + [f"pair {i // 2}" for i in range(300)] + [f"own {i}" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_texts(docs).collect()
    check_law(rows)
    shards: dict[str, set[int]] = {}
    for r in rows:
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(s) - 1 for s in shards.values()) <= 8


def test_group_larger_than_a_shard(spark):
    docs = spark.createDataFrame([(i, "hot" if i < 400 else str(i)) for i in range(1000)], "doc_id long, text string")
    rows = shard_texts(docs).collect()
    check_law(rows)


def test_odd_rows(spark, odd_docs):
    rows = shard_texts(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check_law(rows)
    assert [r.size for r in rows if r.doc_id == 1] == [1]
    assert shard_texts(odd_docs.limit(0)).count() == 0


def test_a_hot_third_beside_many_small_groups(spark):
    texts = ["hot"] * 4_000 + [f"group {i // 10}" for i in range(3_000)] + [f"own {i}" for i in range(5_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_texts(docs).collect()
    check_law(rows)
    shards: dict[str, set[int]] = {}
    for r in rows:
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    hot = sorted(shards.pop("hot"))
    assert len(hot) == 3 and hot[-1] - hot[0] == 2
    assert sum(len(s) > 1 for s in shards.values()) == 0


def test_links_only_and_none_alone(spark):
    # three groups of 260 for shards of 100, and groups of 60 that leave rooms of 40
    texts = [f"hot {i // 260}" for i in range(780)] + [f"group {i // 60}" for i in range(20)]
    rows = shard_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_law(rows)
    texts = [f"group {i // 60}" for i in range(780)] + ["rest"] * 20
    rows = shard_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_law(rows)
    shards: dict[str, set[int]] = {}
    for r in rows:
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(s) - 1 for s in shards.values()) <= 7
