from __future__ import annotations

from pyspark.sql import functions as F

from rankscope.llm import language_cnn
from rankscope.llm.queries import language_id, language_network


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = language_id(spark, folder).join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_is_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = language_network(docs), language_network(docs.repartition(5))
    assert one.labels == two.labels and (one.filters == two.filters).all()


def test_gradient_matches_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (64, 40)).astype(np.int16)
    labels = rng.integers(0, 2, 64)
    net = language_cnn.train(windows, labels, ["a", "b"], epochs=60)
    assert (net.shares(windows).argmax(axis=1) == labels).mean() > 0.9


def test_odd_rows(spark, odd_docs):
    net = language_network(odd_docs)
    rows = odd_docs.select("doc_id", language_cnn.language(net, F.col("text")).alias("said")).collect()
    assert len(rows) == odd_docs.count()
    said = {r.doc_id: r.said for r in rows}
    for doc_id in (1, 2, 6, 7):
        assert said[doc_id].lang_pred == "und" and said[doc_id].score == 0
    assert said[3].lang_pred in net.labels
    assert language_network(odd_docs.limit(0)) is None
    assert language_cnn.predict_texts(None, ["abc", None]) == [("und", 0.0)] * 2
