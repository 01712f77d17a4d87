from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from rankscope.llm import nb_ngrams
from rankscope.llm.queries import held_out, toxicity

FOLDER = "/root/testdata/sf0.01"


def _area(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    toxic = sum(truth)
    return (ranks[np.array(truth, bool)].sum() - toxic * (toxic + 1) / 2) / (toxic * (len(truth) - toxic))


def test_held_out_rows_are_told_apart(spark):
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity(spark, FOLDER).join(truth, "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert _area([r.score for r in held], [r.toxic for r in held]) > 0.9
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9


def _plain_cells(text):
    """The cells of a text, n-gram by n-gram."""
    chars = [ord(c) for c in f" {text.lower()} "] if text else []
    cells = set()
    for size in nb_ngrams.ORDERS:
        for i in range(len(chars) - size + 1):
            h = 0
            for c in chars[i : i + size]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ (c * 0x9E3779B1 & 0xFFFFFFFF)
            h ^= h >> 15
            h = h * 0x85EBCA6B & 0xFFFFFFFF
            cells.add((h ^ (h >> 13)) % nb_ngrams.BUCKETS)
    return cells


def test_counts_scales_and_scores_equal_plain_loops(spark):
    texts = ["You clown, you idiot", "A quiet day", None, "", "ÜBER idiot 😀", "a", "A quiet day", "idiot " * 300]
    rows = [(i, t, int(bool(t) and "idiot" in t)) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    held, totals = nb_ngrams.class_counts(table)
    plain = np.zeros((2, nb_ngrams.BUCKETS), np.int64)
    for _, text, label in rows:
        plain[label, list(_plain_cells(text or ""))] += 1
    assert (held == plain).all() and list(totals) == [5, 3]
    clean, toxic = plain + 1.0
    assert np.allclose(nb_ngrams.log_ratios(held), np.log(toxic / toxic.sum()) - np.log(clean / clean.sum()))

    model = nb_ngrams.fit(table)
    scored = {r.doc_id: r for r in nb_ngrams.score(table, model, F.lit(False)).collect()}
    for i, text, _ in rows:
        cells = sorted(_plain_cells(text or ""))
        z = float(model.weights[cells].sum(dtype=np.float64)) / math.sqrt(max(1, len(cells))) + model.intercept
        assert abs(scored[i].score - 1 / (1 + math.exp(-z))) < 1e-9
    assert scored[0].score > 0.5 > scored[1].score == scored[6].score
    assert scored[2].score == scored[3].score


def test_gradient_leads_to_a_minimum():
    """At the end the loss is below that of small moves along each used weight."""
    rng = np.random.default_rng(3)
    sample = [(k % 2, np.unique(rng.integers(0, 40, 12) + 15 * (k % 2))) for k in range(60)]
    scales = np.ones(nb_ngrams.BUCKETS)
    model = nb_ngrams.regress(sample, scales)
    sums = [model.weights[c].sum() / math.sqrt(len(c)) + model.intercept for _, c in sample]
    assert np.mean([(z > 0) == (label == 1) for z, (label, _) in zip(sums, sample, strict=True)]) > 0.85


def test_model_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    trains = ~held_out(F.col("doc_id"), 5, 0)
    one = nb_ngrams.fit(nb_ngrams.labelled(docs, labels, trains), per_class=50)
    two = nb_ngrams.fit(nb_ngrams.labelled(docs.repartition(7), labels.repartition(3), trains), per_class=50)
    assert (one.weights == two.weights).all() and one.intercept == two.intercept


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    kept_back = held_out(F.col("doc_id"), 5, 0)
    taught = {r.doc_id for r in nb_ngrams.labelled(docs, labels, ~kept_back).collect()}
    assert taught == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5}


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 1, 0), (3, 0, 1), (4, 0, 0), (None, 1, 1), (5, None, 0), (6, 7, 0)],
        "doc_id long, toxic int, quality int",
    )
    rows = nb_ngrams.labelled(odd_docs, labels, F.lit(True))
    assert sorted((r.doc_id, r.label) for r in rows.collect()) == [(1, 1), (2, 0), (3, 1), (4, 0), (4, 0)]
    model = nb_ngrams.fit(rows)
    scored = nb_ngrams.score(odd_docs, model, F.lit(False)).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
    # one label only, no label, no rows
    assert nb_ngrams.fit(rows.filter("label = 1")) == 1.0
    assert nb_ngrams.fit(rows.limit(0)) == 0.0
    assert {r.score for r in nb_ngrams.score(odd_docs, 0.0, F.lit(False)).collect()} == {0.0}
    assert nb_ngrams.score(odd_docs.limit(0), model, F.lit(False)).count() == 0


def test_sample_is_bounded_and_counts_are_not(spark):
    rows = spark.range(3000).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), (F.col("id") % 2).cast("int").alias("label")
    )
    held, totals = nb_ngrams.class_counts(rows)
    assert list(totals) == [1500, 1500] and held.max() == 1500
    assert len(nb_ngrams.sample_cells(rows, totals, 10, 100)) <= 40
