"""Spread joins, ranks and samples against their plain forms, on skewed rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankscope.operators import cohort, joins, ordering, sampling
from rankscope.operators.joins import left_join_by_entity
from rankscope.operators.ordering import hash_order, rank_in_group
from rankscope.plans import charts

ROWS = 3000


def skewed(spark):
    """One artist holds a third of the rows, some rows have no artist, one stratum is large."""
    i = F.col("id").cast("int")
    artist = (
        F.when(i % 3 == 0, F.lit("hot")).when(i % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("a"), (i % 97).cast("string")))
    )
    return spark.range(ROWS, numPartitions=8).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), i % 365).alias("date"),
        F.concat(F.lit("m"), (i % 20).cast("string")).alias("country"),
        (i % 60 + 1).alias("rank"),
        artist.alias("artist_uri"),
        (i % 700).alias("days_on_chart"),
        i.alias("n"),
    )


@pytest.mark.parametrize("rows_per_task", [5, 100, 10**6])
def test_spread_join_equals_plain_join(spark, rows_per_task):
    fact = skewed(spark)
    profile = cohort.entity_profile(fact, rows="__rows")
    spread = left_join_by_entity(fact, profile, "artist_uri", "__rows", rows_per_task)
    plain = fact.join(profile.drop("__rows"), "artist_uri", "left").select(spread.columns)
    assert Counter(spread.collect()) == Counter(plain.collect())
    assert spread.filter("artist_uri is null and artist_tenure is null").count() == 40


def test_spread_join_reads_and_shuffles_the_fact_once(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    profile = cohort.entity_profile(fact, rows="__rows")
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in plain}
    for key, value in plain.items():
        spark.conf.set(key, value)
    try:
        joined = left_join_by_entity(fact, profile, "artist_uri", "__rows", rows_per_task=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{tmp_path}/fact") == 1
        assert plan.count("Exchange hashpartitioning") == 2  # the fact and the light profiles
        parts = joined.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert max(r["count"] for r in parts) < ROWS / 4
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("most", [0, 1])
def test_list_of_heavy_entities_is_bounded(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "MOST_HEAVY", most)
    fact = skewed(spark)
    profile = cohort.entity_profile(fact, rows="__rows")
    assert joins.heavy_entities(profile, "artist_uri", "__rows", 5).count() == most
    spread = left_join_by_entity(fact, profile, "artist_uri", "__rows", 5)
    plain = fact.join(profile.drop("__rows"), "artist_uri", "left").select(spread.columns)
    assert Counter(spread.collect()) == Counter(plain.collect())


def test_a_ranking_evaluates_its_input_once(spark, tmp_path):
    """What comes back reads the numbered rows and the starts of the bins, not the input."""
    skewed(spark).withColumn("h", hash_order(["n"], 7)).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plan = rank_in_group(df, "country", "h")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and f"{tmp_path}/in" not in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_a_hot_group_is_ranked_in_many_parts(spark):
    """One group holds all rows; no task numbers more than a small part of them."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    ranked = rank_in_group(df, "g", "h", "r", digits=2)
    assert ranked.agg(F.count_distinct("r"), F.min("r"), F.max("r")).first() == (20_000, 1, 20_000)
    largest = df.groupBy("g", ordering.hash_bin("h", 2)).count().agg(F.max("count")).first()[0]
    assert largest < 20_000 / 100


def test_population_puts_unknown_artists_in_short_strata(spark):
    people = cohort.population(skewed(spark), excluded="m3", start="2024-02-01", rows_per_task=50)
    unknown = people.filter("artist_uri is null").select("partition_id").distinct().collect()
    assert {r[0] for r in unknown} <= {"Top", "Estable"}
    assert people.filter("country = 'm3' or date < '2024-02-01'").count() == 0


def test_excluding_a_market_drops_unknown_markets(spark):
    df = spark.createDataFrame([("VE",), ("MX",), (None,)], "country string")
    assert [r[0] for r in cohort.without_market(df).collect()] == ["MX"]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_sample_and_ids_are_determined_with_nulls_and_repeats(spark, parts):
    """Unknown artists and exact repeats: the same rows and ids on every layout, ids unique."""
    rows = [("m", None if i % 2 else f"a{i % 30}", dt.date(2024, 1, 1), i % 50, i % 3) for i in range(200)]
    schema = "country string, artist_uri string, date date, rank int, days_on_chart int"
    df = spark.createDataFrame(rows + rows[:20], schema).withColumn("partition_id", F.lit("s"))

    def drawn(n):
        sample = sampling.with_row_id(sampling.sample_exact(df.repartition(n), 50))
        return sorted(sampling.assign_folds(sample, 5).collect(), key=str)

    ids = [r.id for r in sampling.with_row_id(df.repartition(parts)).collect()]
    assert len(set(ids)) == 220
    assert len(drawn(parts)) == 50 and drawn(parts) == drawn(5)


def test_keys_that_join_alike_differ(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "-"), ("-", None)], "x string, y string")
    assert df.select(hash_order(["x", "y"], 1)).distinct().count() == 4


@pytest.mark.parametrize("per_bin", [4, 65_536])
def test_rank_by_score_equals_a_window(spark, monkeypatch, per_bin):
    monkeypatch.setattr(ordering, "KEYS_PER_BIN", per_bin)
    n = F.col("id")
    df = spark.range(4000).select(
        (n % 3).alias("g"), n.alias("key"),
        F.when(n % 2 == 0, n % 7 - 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("score"),
    )
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("score"), "key")))
    ranked = ordering.rank_by_score(df, ["g"], "score", "key", "r")
    assert sorted(ranked.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("digits", [1, 3])
def test_rank_in_group_equals_a_window(spark, digits):
    df = skewed(spark).withColumn("g", F.when(F.col("n") % 3 == 0, "big").otherwise("small"))
    df = df.withColumn("h", hash_order(["n"], 7))
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h")))
    ranked = rank_in_group(df, "g", "h", "r", digits)
    key = ["n", "r"]
    assert sorted(ranked.select(key).collect()) == sorted(plain.select(key).collect())


def people(spark):
    return skewed(spark).filter("artist_uri is not null").withColumn(
        "partition_id",
        F.when(F.col("n") % 10 < 7, "large").when(F.col("n") % 10 < 9, "middle").otherwise("rare"),
    )


@pytest.mark.parametrize("digits", [1, 2, 3])
@pytest.mark.parametrize("target", [1, 50, 1000, 10**6])
def test_exact_sample_equals_brute_force(spark, digits, target):
    df = people(spark)
    rows = df.collect()
    groups = defaultdict(list)
    for r in rows:
        parts = map(str, (r.country, r.artist_uri, r.date, r.n))
        text = "|".join(["42", *(f"{len(p)}:{p}" for p in parts)])
        groups[r.partition_id].append((md5(text.encode()).hexdigest(), r.n))
    expected = set()
    for members in groups.values():
        quota = round(len(members) / len(rows) * target)
        expected |= {n for _, n in sorted(members)[:quota]}
    keys = ("country", "artist_uri", "date", "n")
    sample = sampling.sample_exact(df, target, keys=keys, digits=digits)
    assert sample.columns == df.columns
    assert sorted(r.n for r in sample.collect()) == sorted(expected)


def test_folds_are_even_in_every_stratum(spark):
    keys = ("country", "artist_uri", "date", "n")
    folded = sampling.assign_folds(people(spark), 5, keys=keys)
    sizes = folded.groupBy("partition_id", "fold_id").count().collect()
    per_stratum = defaultdict(list)
    for r in sizes:
        per_stratum[r.partition_id].append(r["count"])
    assert all(len(c) == 5 and max(c) - min(c) <= 1 for c in per_stratum.values())
    again = sampling.assign_folds(people(spark).repartition(3), 5, keys=keys)
    assert sorted(folded.select("n", "fold_id").collect()) == sorted(
        again.select("n", "fold_id").collect()
    )


def test_random_folds_are_even(spark):
    sizes = sampling.assign_folds_random(people(spark), 5).groupBy("partition_id", "fold_id")
    counts = defaultdict(list)
    for r in sizes.count().collect():
        counts[r.partition_id].append(r["count"])
    assert all(max(c) - min(c) <= 1 for c in counts.values())


def test_fold_checks_see_repeated_ids_and_lost_strata(spark):
    df = spark.createDataFrame(
        [("a", "x", 0), ("a", "x", 1), ("b", "y", 0)], "id string, partition_id string, fold_id int"
    )
    row = sampling.fold_checks(df, folds=2).first()
    assert (row.folds_distintos, row.registros_asignados, row.ids_distintos) == (2, 3, 2)
    assert (row.five_balanced_folds, row.unique_ids, row.all_strata_in_folds) == (
        True, False, False,
    )


def test_row_ids(spark):
    df = people(spark)
    ids = sampling.with_row_id(df, ("country", "artist_uri", "date", "n"))
    assert ids.select("id").distinct().count() == df.count()
    running = sampling.with_running_id(df)
    assert running.select("id").distinct().count() == df.count()


def test_train_and_test_rows_part_the_sample(spark):
    folded = sampling.assign_folds(people(spark), 5, keys=("n",))
    train, test = sampling.train_rows(folded, 2), sampling.test_rows(folded, 2)
    assert train.count() + test.count() == folded.count()
    assert {r[0] for r in test.select("fold_id").distinct().collect()} == {2}


def test_bernoulli_sample_is_near_its_target_on_every_layout(spark):
    df, keys = people(spark), ("country", "artist_uri", "date", "n")
    table = cohort.strata(df, 600)
    sample = sampling.sample_bernoulli(df, table, keys=keys)
    drawn = sorted(r.n for r in sample.collect())
    assert abs(len(drawn) - 600) < 120
    again = sampling.sample_bernoulli(df.repartition(3, "n"), table, keys=keys)
    assert drawn == sorted(r.n for r in again.collect())
    other = sampling.sample_bernoulli(df, table, keys=keys, seed=7)
    assert drawn != sorted(r.n for r in other.collect())
    everything = sampling.sample_bernoulli(df, cohort.strata(df, 10**9), keys=keys)
    assert everything.count() == df.count()


def test_complete_rows_and_checks(spark):
    schema = (
        "country string, rank int, days_on_chart int, max_days_on_chart int, "
        "country_count_by_artist long, artist_tenure string, artist_scope string, "
        "rank_tier string, partition_id string"
    )
    rows = [("MX", 1, 1, 1, 1, "a", "b", "c", "a-b-c"), ("MX", None, 1, 1, 1, "a", "b", "c", "x")]
    df = spark.createDataFrame(rows, schema)
    assert sampling.complete_rows(df).count() == 1
    comparison = sampling.compare_strata(cohort.strata(df, 2), df)
    row = sampling.sample_checks(comparison, df, target=2, expected_strata=2).first()
    assert (row.n_M, row.n_M_clean, row.nothing_lost) == (2, 1, False)
    assert (row.all_strata_sampled, row.size_near_target, row.max_abs_diff_pct) == (True, True, 0.0)
    assert sampling.critical_nulls(df).first().rank == 1


@pytest.mark.parametrize("exact", [True, False])
def test_a_sample_is_not_shuffled_by_stratum(spark, tmp_path, exact):
    """However large the population: rows meet their stratum's quota where they are read."""
    skewed(spark).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = ("country", "artist_uri", "date", "rank", "n")
        if exact:
            drawn = sampling.sample_exact(df, 100, stratum="country", keys=keys)
        else:
            drawn = sampling.sample_bernoulli(df, cohort.strata(df, 100, "country"), "country", keys)
        plan = drawn._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
        assert drawn.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SF_DIR = "/root/testdata/sf0.001"


def test_lines_are_shuffled_once_for_their_score(spark):
    """Suppliers reach the lines by broadcast, whatever the planner takes them for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = charts._shipped(spark, SF_DIR, "month", "nation")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_a_window_task_are_bounded(spark, monkeypatch):
    """Small parts are not joined to large ones where the number of rows is known."""
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 50)
    chart = spark.range(1000).selectExpr("date_add(date'2024-01-01', int(id % 5)) fecha", "concat('m', id % 2) pais", "id key", "int(id) rank")
    plain = charts.with_history(chart, F.date_sub("fecha", 1), "days", "streak")
    bounded = charts.with_history(chart, F.date_sub("fecha", 1), "days", "streak", 1000)
    assert bounded._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert Counter(bounded.collect()) == Counter(plain.collect())
    parts = bounded.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in parts) < 150


def test_a_profile_join_does_not_sort_the_fact(spark, monkeypatch):
    monkeypatch.setattr(joins, "HASHED_FROM", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = skewed(spark)
        profile = cohort.entity_profile(fact, rows="__rows")
        hashed = left_join_by_entity(fact, profile, "artist_uri", "__rows", 100)
        plan = hashed._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        plain = fact.join(profile.drop("__rows"), "artist_uri", "left").select(hashed.columns)
        assert Counter(hashed.collect()) == Counter(plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("most", [0, 10**6])
def test_a_weekly_chart_is_joined_once_with_what_is_known_of_parts(spark, monkeypatch, most):
    """Labels need no orders; labels and dates come from one table, broadcast or hashed."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
    join = "BroadcastHashJoin" if most else "ShuffledHashJoin"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both, labels = charts.weekly_raw(spark, SF_DIR), charts.weekly_raw_with_brand(spark, SF_DIR)
        for df in (both, labels):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count(join) == 1 and "SortMergeJoin" not in plan and plan.count("FileScan parquet") == 2
        assert labels.columns == both.columns
        assert Counter(labels.drop("release_date").collect()) == Counter(both.drop("release_date").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
