from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import corpus_pipeline
import pytest
import tiktoken
from tables import TINY
from test_ngram_join import brute

from rankscope.llm import byte_bpe
from rankscope.llm.common import CLEAN_UP, discard, store
from rankscope.llm.queries import PATTERN, RANKS


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], TINY)))
    return out


def test_stages(spark, steps):
    docs, said, single, hidden, mixed, tokens = [s.collect() for s in steps]
    for before, after in zip(steps[:4], steps[1:5], strict=True):
        assert after.columns == before.columns and after.count() <= before.count()
    # invented prose is kept; letters and a likely language are all it needs
    assert len(said) >= 0.98 * len(docs)
    classes = {i: c for i, _, c in brute([(r.doc_id, r.text) for r in said])}
    assert sorted(r.doc_id for r in single) == sorted(i for i, c in classes.items() if i == c)
    assert sorted(r.doc_id for r in hidden) == sorted(r.doc_id for r in single)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in hidden} and len({r.doc_id for r in mixed}) == len(mixed)
    encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=byte_bpe.vocabulary(RANKS).ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed}
    assert {r.doc_id: r.token_ids for r in tokens} == {i: encoding.encode_ordinary(t) for i, t in texts.items()}


def test_run_equals_the_stages(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, TINY).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_odd_rows_pass_every_stage(spark, odd_docs):
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, odd_docs, TINY).columns == odd_docs.columns
    near = corpus_pipeline.drop_near_copies(spark, odd_docs, TINY).collect()
    assert sorted((r.doc_id for r in near), key=str) == [1, 2, 3, 4, 6, 7, None]
    assert corpus_pipeline.encode_tokens(spark, odd_docs, TINY).count() == odd_docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), TINY).count() == 0


def test_language_stage_passes_texts_to_python_once(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    plan = corpus_pipeline.identify_language(spark, docs, TINY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_without_labels_every_text_with_a_letter_stays(spark):
    rows = [(1, "some words", None, "a"), (2, "12 !", None, "a"), (3, None, None, "b"), (None, "mots", None, None), (4, "", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.identify_language(spark, docs, TINY)
    assert sorted((r.text, r.lang) for r in kept.collect()) == [("mots", None), ("some words", None)]


def test_one_row_of_a_repeated_id_stays_on_every_layout(spark):
    rows = [(i % 3, f"text number {i} of a repeated id {'x ' * i}", "en", f"s{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = [sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs.repartition(n), TINY).collect())) for n in (1, 4)]
    assert found[0] == found[1] and [r[0] for r in found[0]] == [0, 1, 2]


def test_store_refuses_a_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    values = {"spark.master": "spark://host:7077"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values.get(key, default)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store(SimpleNamespace(sparkSession=session))


def test_store_leaves_the_setting_as_it_was(spark):
    before = spark.conf.get(CLEAN_UP)
    stored = store(spark.range(1000).repartition(3, "id"))
    assert stored.count() == 1000 and spark.conf.get(CLEAN_UP) == before


def test_discard_deletes_stored_tables_only(spark):
    stored = store(spark.range(10))
    folder = Path(urlparse(stored.inputFiles()[0]).path).parent
    assert folder.is_dir()
    discard(stored)
    assert not folder.exists()
    with pytest.raises(ValueError, match="was not made by store"):
        discard(spark.read.parquet(f"{TINY}/documents.parquet"))
