from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from rankscope.llm import periodic_runs as pr
from rankscope.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(words):
    """All runs by trying every period: stretches of equal words q apart, the smallest period of each."""
    n, found = len(words), {}
    codes = np.unique(np.array([hash(w) for w in words], np.int64), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 3 + 1):
        same = np.concatenate([[False], codes[q:] == codes[:-q], [False]]).astype(int)
        step = np.diff(same)
        for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True):
            if b - a + q >= max(24, 3 * q):
                found.setdefault((int(a), int(b - a + q)), q)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def as_rows(runs):
    return list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True))


def _text(rng, letters, size):
    """Words with repeated stretches inside repeated stretches."""
    out = []
    while len(out) < size:
        part = list(rng.integers(0, letters, rng.integers(1, 12)))
        for _ in range(rng.integers(0, 3)):
            part = part * int(rng.integers(1, 6)) + list(rng.integers(0, letters, rng.integers(0, 3)))
            if len(part) > size:
                break
        out += part
    return [f"w{x}" for x in out[:size]]


@pytest.mark.parametrize("letters", [1, 2, 3, 6, 40])
def test_equals_brute_force(letters):
    rng = np.random.default_rng(letters)
    texts = [_text(rng, letters, int(rng.integers(0, 400))) for _ in range(150)]
    texts += [["a"] * k for k in (0, 1, 23, 24, 25, 64)] + [texts[0], texts[0]]
    for words, runs in zip(texts, pr.runs_of_texts(texts), strict=True):
        assert as_rows(runs) == brute(words)


def test_fibonacci_and_doubling_words():
    a, b = ["a"], ["a", "b"]
    while len(b) < 1500:
        a, b = b, b + a
    thue = ["01"[bin(i).count("1") % 2] for i in range(1500)]
    nested = []
    for k in range(1, 9):
        nested = nested * 3 + [f"x{k}"]
    for words in (b, thue, nested[:4000], (b[:50] + ["z"]) * 40, b[:300] * 4 + thue[:200] * 3):
        assert as_rows(pr.runs_of_texts([words])[0]) == brute(words)


def test_wavelet_and_factors_equal_plain_code():
    rng = np.random.default_rng(0)
    values = rng.permutation(300)
    w = pr.Wavelet(values, 9)
    low = rng.integers(0, 300, 200)
    high = np.minimum(300, low + rng.integers(1, 80, 200))
    bound = rng.integers(0, 511, 200)
    assert list(w.below(low, high, bound)) == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound, strict=True)]
    rank = rng.integers(0, high - low)
    assert list(w.smallest(low, high, rank)) == [sorted(values[a:b])[r] for a, b, r in zip(low, high, rank, strict=True)]
    words = np.append(rng.integers(0, 2, 200), 9)
    f = pr.Factors(words)
    assert list(f.order) == sorted(range(201), key=lambda i: words[i:].tolist())
    for x, y in rng.integers(0, 201, (100, 2)):
        if x != y:
            same = next((i for i in range(201) if max(x, y) + i >= 201 or words[x + i] != words[y + i]), 0)
            before = next((i for i in range(202) if min(x, y) - i < 1 or words[x - i - 1] != words[y - i - 1]), 0)
            assert f.equal_after(np.array([x]), np.array([y]))[0] == same
            assert f.equal_before(np.array([x]), np.array([y]))[0] == before


def expected(doc_id, text):
    """The contract's row by plain code."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    digest = [
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    ]
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, *digest)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {tuple(r) for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    assert found == {expected(d.doc_id, d.text) for d in docs}
    assert sum(r[1] > 0 for r in found) > len(docs) / 20


def test_odd_rows(spark, odd_docs):
    found = sorted(map(tuple, pr.report(odd_docs, plant=True).collect()), key=str)
    assert found == sorted((expected(r.doc_id, r.text) for r in odd_docs.collect()), key=str)
    long = next(r for r in found if r[0] == 3)
    assert long[1] == 1 and long[4] == 1
    assert pr.report(odd_docs.limit(0)).count() == 0


def test_white_space_of_other_scripts_does_not_split(spark):
    text = "a\u00a0b " * 30 + "\x1c c\x85d"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pr.report(docs).first()
    assert tuple(row) == expected(1, text) and (row.start, row.length, row.period) == (0, 30, 1)


def test_long_texts_stay_whole():
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in rng.integers(0, 9, 100_000)]
    words += words[-70_000:] * 3
    runs = as_rows(pr.runs_of_texts([["x"] * 30, words, ["y"] * 40])[1])
    assert (30_000, 280_000, 70_000) in runs
    assert max(q for _, _, q in runs) == 70_000
