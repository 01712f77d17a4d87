"""Every registered query against its SQL twin, and the shape of every plan."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from rankscope.plans.oracles import ORACLES
from rankscope.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
# Markets there have too few rows for a diagnosis on the smallest tables.
MARKETS = {"market_diagnostics", "market_anomalies", "market_volatility", "market_stable"}
# On the smallest tables no artist is global, so four of the eight strata are empty.
COHORT = {
    "entity_profile", "population", "strata", "sample_exact", "strata_compare", "sample_checks",
    "folds", "fold_sizes", "split_sizes", "fold_pivot", "fold_checks", "class_share", "composition", "run_summary",
    "sample_bernoulli", "written_strata", "written_document", "fixed_clusters", "fixed_cluster_score", "tree_scores",
}
FITTED = {
    "forest_cv", "forest_vs_baseline", "importance", "tuning", "kmeans_sweep", "clusters",
    "cluster_composition",
}
FITTED_WITH_SQL = {"cluster_totals", "cluster_strata"}
SKETCHED = {"numeric_summary"}


@pytest.fixture(scope="module")
def connections():
    return {sf_dir: connect(sf_dir) for sf_dir in (SF_DIR, LARGER)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connections, name):
    sf_dir = LARGER if name in MARKETS | COHORT else SF_DIR
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert difference(spark, connections[sf_dir], sf_dir, query, sql) == ""


def test_only_fitted_and_sketched_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED | SKETCHED
    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["artist_name", "dias_pais_en_no1", "paises_con_no1"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED - FITTED_WITH_SQL))
def test_plan_has_no_pairing_of_all_rows(spark, name):
    """No join without an equality key: it would not survive growth."""
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_leader_plan_cuts_before_the_shuffle_and_reads_four_columns(spark):
    plan = entry.queries()["leaders"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "props" not in plan and "event_id" not in plan


@pytest.mark.parametrize("name", ["population", "sample_exact", "folds", "scaled", "strata", "band_permanence", "auc"])
def test_stored_intermediates_are_read_not_built_again(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("FileScan parquet") <= 2
    assert "lineitem" not in plan and "events.parquet" not in plan


def test_landed_chart_is_read_by_month(spark):
    plan = entry.queries()["landed_months"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


@pytest.mark.parametrize("name", ["null_profile", "schema_rows", "numeric_summary", "table_profile"])
def test_profiles_read_their_table_once(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
