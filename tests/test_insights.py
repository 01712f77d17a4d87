"""Insight operators on small hand-made charts: ties, NULLs, empty tables."""

from __future__ import annotations

import datetime as dt

from rankscope.functions.banding import band_order
from rankscope import vocabulary as v
from rankscope.operators import facts, leadership, profiling, releases, turnover

CHART = (
    "fecha date, pais string, rank int, artist_uri string, artist_name string, "
    "days_on_chart int, consecutive_days int, entry_status string"
)


def day(n):
    return dt.date(2024, 1, n)


def chart(spark, rows):
    return spark.createDataFrame(rows, CHART)


def test_leaders_group_by_name_or_by_key(spark):
    df = chart(spark, [
        (day(1), "MX", 1, "u1", "Same", 1, 1, "NEW_ENTRY"),
        (day(1), "US", 1, "u2", "Same", 1, 1, "NEW_ENTRY"),
        (day(1), "AR", 2, "u3", "Other", 1, 1, "NEW_ENTRY"),
    ])
    assert [tuple(r) for r in leadership.leaders(df).collect()] == [("Same", 2, 2)]
    assert leadership.leaders(df, entity="artist_uri").count() == 2


def test_leader_share_breaks_ties_by_name(spark):
    rows = [(day(i % 28 + 1), "MX", 1, f"u{i}", f"N{i:02d}", 1, 1, "NEW_ENTRY") for i in range(12)]
    row = leadership.leader_share(leadership.leaders(chart(spark, rows))).first()
    assert abs(row.share_top10 - 10 / 12) < 1e-12
    assert (row.total_no1, row.artist_name, row.dias_pais_en_no1) == (12, "N00", 1)


def test_leader_share_of_an_empty_chart(spark):
    row = leadership.leader_share(leadership.leaders(chart(spark, []))).first()
    assert row.share_top10 is None and row.artist_name is None


def test_leader_reach_segments(spark):
    table = spark.createDataFrame(
        [("a", 500, 30), ("b", 400, 3), ("c", 150, 1), ("d", 149, 1), ("e", 400, 20)],
        "artist_name string, dias_pais_en_no1 long, paises_con_no1 long",
    )
    rows = [(r.segment, r.artist_name) for r in leadership.leader_reach(table).collect()]
    assert rows == [
        ("highlighted", "a"), ("highlighted", "e"), ("highlighted", "b"), ("highlighted", "c"),
        ("local", "b"), ("local", "c"), ("global", "a"), ("global", "e"),
    ]


def test_diversity_window_counts_rows_not_days(spark):
    rows = []
    for n, leaders in ((1, 1), (2, 3), (20, 2)):
        for i in range(leaders):
            rows.append((day(n), f"M{i}", 1, f"u{i}", f"N{i}", 1, 1, "NEW_ENTRY"))
    result = leadership.leader_diversity(chart(spark, rows), rows=2)
    assert [(r[1], r[2]) for r in result.collect()] == [(1, 1.0), (3, 2.0), (2, 2.5)]
    assert tuple(leadership.leader_diversity_facts(result).first()) == (1, 3, 2.0)


def test_status_shares_and_first_peak(spark):
    rows = [
        (day(1), "MX", 1, "a", "a", 1, 1, "NEW_ENTRY"),
        (day(1), "MX", 2, "b", "b", 1, 1, None),
        (day(2), "MX", 1, "a", "a", 2, 2, "NO_CHANGE"),
        (day(2), "MX", 2, "b", "b", 1, 1, "RE_ENTRY"),
        (day(2), "MX", 11, "c", "c", 1, 1, "NEW_ENTRY"),
    ]
    status = turnover.top_status(chart(spark, rows))
    assert [tuple(r) for r in status.collect()] == [
        (day(1), 0.5, 0.0, 0.0, 0.0), (day(2), 0.0, 0.5, 0.5, 0.0),
    ]
    assert tuple(turnover.turnover_facts(status).first()) == (0.5, 0.25, day(1), 0.5)


DIAGNOSTICS = (
    "pais string, observaciones_top10 long, dias_cubiertos long, share_new_entry_top10 double, "
    "share_no_change_top10 double, mediana_days_on_chart int"
)


def test_market_with_unknown_median_is_in_neither_table(spark):
    df = spark.createDataFrame(
        [
            ("stuck", 1000, 10, 0.95, 0.2, 9), ("fresh", 1000, 10, 0.5, 0.0, 1),
            ("unknown", 1000, 10, 0.5, 0.0, None), ("calm", 1000, 10, 0.1, 0.6, 40),
            ("brisk", 1000, 10, 0.4, 0.6, 20), ("known", 1000, 10, 0.2, 0.1, None),
        ],
        DIAGNOSTICS,
    )
    assert [r.pais for r in turnover.anomalous_markets(df).collect()] == ["fresh", "stuck"]
    volatile = turnover.volatile_markets(df)
    assert [r.pais for r in volatile.collect()] == ["brisk", "known", "calm"]
    assert [r.pais for r in turnover.volatile_markets(df, limit=1).collect()] == ["brisk"]
    assert [r.pais for r in turnover.stable_markets(volatile, limit=2).collect()] == [
        "brisk", "calm",
    ]


def test_market_diagnostics_needs_enough_rows(spark):
    rows = [(day(i % 28 + 1), "MX", 1 + i % 10, f"u{i}", f"u{i}", i, 1, "NO_CHANGE")
            for i in range(30)]
    rows += [(day(1), "US", 1, "a", "a", 1, 1, "NEW_ENTRY")]
    result = turnover.market_diagnostics(chart(spark, rows), min_rows=30).collect()
    assert [tuple(r) for r in result] == [("MX", 30, 28, 0.0, 1.0, 14)]


def test_band_permanence_skips_unknown_rank_and_orders_bands(spark):
    rows = [
        (day(1), "MX", 150, "a", "a", 5, 1, "NEW_ENTRY"),
        (day(1), "MX", 3, "b", "b", 9, 4, "NO_CHANGE"),
        (day(1), "MX", None, "c", "c", 9, 4, "NO_CHANGE"),
        (day(1), "MX", 4, "d", "d", None, 4, "NO_CHANGE"),
    ]
    result = turnover.band_permanence(chart(spark, rows)).collect()
    assert [tuple(r) for r in result] == [("1-10", 9, 4, 0.0), ("101-200", 5, 1, 1.0)]


ALBUMS = (
    "fecha date, rank int, album_uri string, label string, weeks_on_chart int, entry_rank int, "
    "days_release_to_entry int"
)


def albums(spark, rows):
    return spark.createDataFrame([(day(1), *r) for r in rows], ALBUMS)


def test_labels_merge_blank_and_missing(spark):
    df = albums(spark, [
        (1, "a", "X", 1, 1, 0), (2, "b", " X", 1, 1, 0), (1, "c", None, 1, 1, 0),
        (10, "c", "  ", 1, 1, 0), (11, "d", "X", 1, 1, 0),
    ])
    assert [tuple(r) for r in releases.label_top(df).collect()] == [
        ("Sin etiqueta", 2, 1), (" X", 1, 1), ("X", 1, 1),
    ]
    assert [tuple(r) for r in releases.label_first(df).collect()] == [
        ("Sin etiqueta", 1), ("X", 1),
    ]


def test_release_lag_keeps_the_closed_range(spark):
    df = albums(spark, [(1, "a", "X", 1, 1, lag) for lag in (-1, 0, 7, 8, 3650, 3651, None)])
    lags = releases.release_lag(df)
    assert [tuple(r) for r in lags.collect()] == [
        ("0-7", 2, 0.5), ("8-30", 1, 0.25), ("366-3650", 1, 0.25),
    ]
    assert tuple(releases.release_lag_facts(lags).first()) == (0.5, 0.75, 0.25)


def test_debut_facts_prefer_the_better_band_on_ties(spark):
    df = albums(spark, [
        (1, "a", "X", 5, 1, 0), (60, "b", "X", 5, 60, 0), (9, "c", "X", 2, 60, 0),
        (20, "d", "X", None, 1, 0), (20, "e", "X", 9, None, 0),
    ])
    debut = releases.debut_permanence(df)
    assert [tuple(r) for r in debut.collect()] == [("1-10", 5, 1.0), ("51-100", 2, 0.5)]
    assert tuple(releases.debut_facts(debut).first()) == ("1-10", 5, "1-10", 1.0)
    assert debut.orderBy(band_order("banda_entry", v.RANK_BANDS)).first()[0] == "1-10"


def test_executive_sentences(spark):
    artist = chart(spark, [
        (day(1), "MX", 1, "a", "Ana", 3, 1, "NEW_ENTRY"),
        (day(1), "MX", 150, "b", "Bea", 1, 1, "NEW_ENTRY"),
        (day(2), "MX", 1, "a", "Ana", 4, 2, "NO_CHANGE"),
    ])
    album = albums(spark, [(1, "a", "X", 1, 1, 0)])
    result = facts.executive_facts(
        leadership.leader_share(leadership.leaders(artist)),
        turnover.turnover_facts(turnover.top_status(artist)),
        leadership.leader_diversity_facts(leadership.leader_diversity(artist)),
        turnover.band_permanence(artist),
        releases.label_top(album),
        releases.release_lag_facts(releases.release_lag(album)),
        releases.debut_facts(releases.debut_permanence(album)),
    ).collect()
    texts = dict((r.topic, r.text) for r in result)
    assert sorted(texts) == [1, 2, 3, 4, 5, 6, 7] and len(result) == 20
    assert texts[1] == (
        "Ten entities hold 100.0% of all first places; Ana leads with 2 market-days in 1 markets."
    )
    assert "50.00% of the top ten entered" in texts[2]
    assert "1-10: 3, 101-200: 1." in texts[4]
    assert {r.fact: r.name for r in result if r.name} == {
        "leader": "Ana", "label": "X", "longest_band": "1-10", "best_top_band": "1-10",
    }


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None)], "a int, b string, `c.d` double")
    nulls = [tuple(r) for r in profiling.null_profile(df).collect()]
    assert nulls == [("b", 2, 100.0), ("c.d", 1, 50.0), ("a", 0, 0.0)]
    empty = profiling.null_profile(df.limit(0)).collect()
    assert {(r.null_count, r.null_pct) for r in empty} == {(0, None)}
    assert profiling.numeric_columns(df) == ["a", "c.d"]
    assert profiling.numeric_summary(df.select("b")) is None
    first = profiling.numeric_summary(df).first()
    assert (first["count"], first["mean"], first["min"], first["max"]) == (2, 1.5, 1.0, 2.0)
    assert [r.data_type for r in profiling.schema_rows(df).collect()] == ["int", "string", "double"]


def test_population_audit_counts_nulls_and_repeats(spark):
    rows = [(day(1), "MX", 1, "a", 1)] * 3 + [(day(2), None, 1, "a", 1), (None, "MX", None, None, 1)]
    df = spark.createDataFrame(
        rows, "date date, country string, rank int, artist_uri string, days_on_chart int"
    )
    assert tuple(profiling.population_audit(df).first()) == (5, day(1), day(2), 1, 1, 1, 1, 0, 1)
    assert profiling.population_audit(df.limit(0)).first().n_original == 0


def test_coverage_counts_a_null_market(spark):
    df = chart(spark, [(day(1), None, 1, "a", "a", 1, 1, "x"), (day(2), "MX", 1, "a", "a", 1, 1, "x")])
    assert tuple(profiling.coverage(df, "t").first()) == ("t", 2, 2, day(1), day(2))
