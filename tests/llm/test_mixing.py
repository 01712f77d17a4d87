from __future__ import annotations

import duckdb
from tables import TINY
from pyspark.sql import functions as F

from rankscope.llm import mixing
from rankscope.llm.oracles import ORACLES
from rankscope.llm.queries import weighted_mix


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{TINY}/documents.parquet'")
    got = sorted(map(tuple, weighted_mix(spark, TINY).collect()), key=str)
    assert got == sorted(con.sql(ORACLES["op8_mixing"]).fetchall(), key=str)


def leaves(spark, rooms):
    rows = [(*path.split("/"), room) for path, room in rooms.items()]
    return spark.createDataFrame(rows, "domain string, lang string, source string, room long")


def given(spark, rooms, total, weights):
    rows = mixing.budgets(leaves(spark, rooms), F.lit(total), weights).collect()
    return {f"{r.domain}/{r.lang}/{r.source}": r.budget for r in rows}


def test_shortage_goes_to_siblings_first(spark):
    rooms = {"a/x/1": 10, "a/x/2": 1000, "a/y/1": 1000, "b/x/1": 1000}
    got = given(spark, rooms, 800, {})
    # a and b 400 each; x and y 200 each; source 1 is short by 90, which its sibling takes
    assert got == {"a/x/1": 10, "a/x/2": 190, "a/y/1": 200, "b/x/1": 400}


def test_shortage_goes_up_when_no_sibling_can_take_it(spark):
    rooms = {"a/x/1": 10, "a/x/2": 20, "a/y/1": 50, "b/x/1": 1000}
    assert given(spark, rooms, 400, {}) == {"a/x/1": 10, "a/x/2": 20, "a/y/1": 50, "b/x/1": 320}


def test_weights_and_rounding(spark):
    rooms = {"a/x/1": 1000, "a/x/2": 1000, "a/x/3": 1000}
    got = given(spark, rooms, 100, {"source": {"1": 2}})
    assert got == {"a/x/1": 50, "a/x/2": 25, "a/x/3": 25}
    assert sum(given(spark, rooms, 101, {}).values()) == 101
    assert sum(given(spark, rooms, 10_000, {}).values()) == 3000


def test_epochs_repeat_a_short_leaf(spark):
    docs = spark.createDataFrame([(i, "word" * 10, "en", "s") for i in range(8)], "doc_id long, text string, lang string, source string")
    rows = mixing.select(docs, 2.0, {}, F.lit("d"), epochs=3).collect()
    assert sum(r.n_tokens for r in rows) == 160
    assert all(sum(r.row.doc_id == i and r.epoch == e for r in rows) == 1 for i in range(8) for e in (0, 1))


def test_layout_does_not_matter_and_bins_agree(spark, monkeypatch):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    whole = {tuple(r)[1:] for r in mixing.select(docs, 0.5, {}, F.lit("d")).collect()}
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", 3)
    cut = {tuple(r)[1:] for r in mixing.select(docs.repartition(7), 0.5, {}, F.lit("d")).collect()}
    assert whole == cut


def test_odd_rows(spark, odd_docs):
    rows = mixing.select(odd_docs, 1.0, {"lang": {"en": 0}}, F.lit(None).cast("string")).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.domain, r.lang, r.source) for r in rows if r.row.doc_id == 1} == {("", "", "")}
    assert mixing.select(odd_docs, 0.0, {}, F.lit("d")).count() == 0
    assert mixing.select(odd_docs.limit(0), 0.5, {}, F.lit("d")).count() == 0


def test_rows_that_share_or_lack_an_id_are_spread_over_bins(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", 4)
    rows = [(None if i % 2 else 7, f"text number {i}", "en", "s", i, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, bin int")
    taken = mixing.select(docs, 0.5, {}, F.lit("d")).collect()
    assert sum(r.n_tokens for r in taken) >= sum((len(r[1]) + 3) // 4 for r in rows) // 2
    assert 100 < len(taken) < 300 and len({r.row.text for r in taken}) == len(taken)
    # both the shared id and the missing one are taken about evenly, so neither fills a bin by itself
    assert 60 < sum(r.row.doc_id is None for r in taken) < 140
    again = mixing.select(docs.repartition(5), 0.5, {}, F.lit("d")).collect()
    assert {(r.row.text, r.tokens_before) for r in again} == {(r.row.text, r.tokens_before) for r in taken}
