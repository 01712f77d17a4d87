from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tables import TINY

from rankscope.llm import byte_bpe
from rankscope.llm.queries import PATTERN, RANKS, bpe_digests


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.vocabulary(RANKS).ranks
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_equal_the_library(reference):
    rng = random.Random(3)
    parts = ["ab", "é", " ", "  ", "\n", " \n ", "'s", "don't", "12", "\x1c", "\x85", "　", "日本", "!?", "😀", "²"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    flat, bounds = byte_bpe.Encoder(RANKS, PATTERN).encode(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert flat[a:b].tolist() == reference.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("size", [1023, 1024, 1025, 9000])
def test_long_pieces(reference, size):
    text = "".join(random.Random(size).choices("etaoinshrdlu", k=size))
    assert byte_bpe.Encoder(RANKS, PATTERN).encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_forgetting_words_changes_nothing(reference, monkeypatch, tiny_docs):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    encoder = byte_bpe.Encoder(RANKS, PATTERN)
    for text in tiny_docs.text[:40]:
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_round_trip_with_odd_rows(spark, odd_docs, reference):
    coded = byte_bpe.encode(odd_docs.withColumnRenamed("row", "token_ids"), RANKS, PATTERN)
    rows = byte_bpe.decode(coded, RANKS).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert bytes(row.decoded).decode() == (row.text or "")
        assert row.token_ids == reference.encode_ordinary(row.text or "")
    assert byte_bpe.encode(odd_docs.limit(0), RANKS, PATTERN).count() == 0


def test_a_batch_is_encoded_and_handed_on_in_stretches(spark, odd_docs, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["ab", "don't", "日本", "x" * 40], k=rng.randint(0, 60))) for _ in range(400)]
    texts[7], texts[8], texts[9] = None, "", "long " * 3000
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": pa.array(texts, pa.string())})
    for size, parts in [(1, 350), (5000, 30), (10**9, 1)]:
        monkeypatch.setattr(byte_bpe, "TOGETHER", size)
        with monkeypatch.context() as m:
            m.setattr(type(odd_docs), "mapInArrow", lambda self, run, schema: run)
            run = byte_bpe.encode(odd_docs.select("doc_id", "text"), RANKS, PATTERN)
        made = list(run(iter([batch.slice(0, 0), batch, batch.slice(3, 20)])))
        assert len(made) >= parts
        for part in made:
            # all but the last text of a stretch begin and end inside it
            assert sum(len((t or "").encode()) for t in part.column("text").to_pylist()[:-1]) <= size
        rows = pa.Table.from_batches(made).to_pylist()
        assert [r["doc_id"] for r in rows] == [*range(400), *range(3, 23)]
        whole = byte_bpe.Encoder(RANKS, PATTERN)
        for row in rows:
            assert row["text"] == texts[row["doc_id"]]
            assert row["token_ids"] == whole.encode([row["text"] or ""])[0].tolist()


def test_words_that_were_encoded_are_not_kept_twice():
    encoder = byte_bpe.Encoder(RANKS, PATTERN)
    for turn in range(3):
        encoder.encode([" ".join(f"w{turn}x{i}" for i in range(1000))])
        assert len(encoder.words) == 1000 * (turn + 1)
        assert not encoder.words.waiting and not encoder.pieces.waiting


def test_query_equals_the_library(spark, tiny_docs, reference):
    got = bpe_digests(spark, TINY).toPandas().set_index("doc_id")
    for row in tiny_docs.itertuples():
        ids = np.array(reference.encode_ordinary(row.text or ""), "<u4")
        found = got.loc[row.doc_id]
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
