"""Files in and out: round trips in a fresh folder."""

from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest

from rankscope import vocabulary as v
from rankscope.plans import charts
from rankscope.plans.studies import run_audit, run_insights
from rankscope.session import kept
from rankscope.sources import readers, registry, sinks

SF_DIR = "/root/testdata/sf0.001"
ARTISTS = """date,country,rank,uri,artist_name,peak_rank,previous_rank,days_on_chart,consecutive_days,entry_status,entry_rank,entry_date
2024-01-01,MX,1,u1,Ana,1,,10,3,NO_CHANGE,5,2023-12-01
2024-01-01,MX,x,u2,"Bea, B.",2,3,,1,MOVED_UP,9,2023-02-30
2024,US,99999999999,u3,Cy,2,3,7.0,1,NEW_ENTRY, 9,2024-01-01
"""


def write(path, text):
    if str(path).endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


@pytest.mark.parametrize("name", ["a.csv", "a.csv.gz"])
@pytest.mark.parametrize("columns", [None, v.ARTISTS_DAILY_COLUMNS])
def test_text_csv_to_typed_artists(spark, tmp_path, name, columns):
    raw = readers.read_text_csv(spark, write(tmp_path / name, ARTISTS), columns)
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    rows = readers.artists_daily(raw).collect()
    assert [r.rank for r in rows] == [1, None, None]
    assert [r.fecha for r in rows] == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), None]
    assert [r.days_on_chart for r in rows] == [10, None, None]
    assert [r.entry_date for r in rows] == [dt.date(2023, 12, 1), None, dt.date(2024, 1, 1)]
    assert rows[1].artist_name == "Bea, B."
    study = readers.study_rows(raw).collect()
    assert [tuple(r) for r in study][0] == (dt.date(2024, 1, 1), "MX", 1, "u1", "Ana", 10)


def test_inferred_csv(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,c\n1,2.5,x\n2,,y\n")
    df = readers.read_inferred_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string"]


def test_typed_albums_keep_the_raw_text(spark, tmp_path):
    text = ",".join(v.ALBUMS_WEEKLY_COLUMNS) + "\n"
    text += "2024-01-05,MX,2,a1,Al,Ana,X,3,1,NEW_ENTRY,2,2024-01-05,2024-01-01\n"
    text += "2024-01-05,MX,3,a2,Bo,Bea,,3,1,NEW_ENTRY,n/a,2024-01-05,2024\n"
    raw = readers.read_text_csv(spark, write(tmp_path / "al.csv", text))
    rows = readers.albums_weekly(raw).collect()
    assert [r.days_release_to_entry for r in rows] == [4, None]
    assert (rows[1].release_date_raw, rows[1].release_date) == ("2024", None)
    assert (rows[1].entry_rank_raw, rows[1].entry_rank, rows[1].label) == ("n/a", None, None)


def test_registry_and_guard(spark, tmp_path):
    write(tmp_path / "songs.csv", "a\n1\n")
    status = registry.file_status(spark, str(tmp_path))
    assert status.count() == 8
    assert registry.present_files(status) == {"songs": f"{tmp_path}/songs.csv"}
    assert registry.require_files(status, "songs").count() == 1
    with pytest.raises(FileNotFoundError, match="albums.csv"):
        registry.require_files(status, "songs", "albums")
    with pytest.raises(FileNotFoundError, match="links.csv"):
        registry.require_files(status)
    with pytest.raises(FileNotFoundError, match="unheard_of"):
        registry.require_files(status, "unheard_of")


def test_landed_chart_is_pruned_by_month(spark, tmp_path):
    chart = charts.daily_chart(spark, SF_DIR)
    path = str(tmp_path / "daily")
    sinks.land_chart(chart, path)
    landed = spark.read.parquet(path)
    assert sorted(landed.select(chart.columns).collect()) == sorted(chart.collect())
    plan = landed.filter("month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_audit_writes_profiles(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    with pytest.raises(FileNotFoundError):
        run_audit(spark, str(raw), out)
    write(raw / "charts_artists_daily.csv.gz", ARTISTS)
    write(raw / "links.csv", "name\nx\n\ny\n")
    combined = run_audit(spark, str(raw), out)
    assert [(r.table_name, r.row_count, r.column_count) for r in combined.collect()] == [
        ("charts_artists_daily", 3, 12), ("links", 2, 1),
    ]
    nulls = spark.read.parquet(f"{out}/charts_artists_daily_nulls.parquet")
    assert nulls.orderBy("column_name").filter("null_count > 0").collect()[0].column_name == (
        "days_on_chart"
    )
    numbers = spark.read.parquet(f"{out}/charts_artists_daily_numeric_summary.parquet")
    assert numbers.filter("column_name = 'peak_rank'").first()["q50"] == 2.0
    assert not registry.path_exists(spark, f"{out}/links_numeric_summary.parquet")
    assert spark.read.parquet(f"{out}/combined_table_summary.parquet").count() == 2


def test_result_table_and_document_round_trip(spark, tmp_path):
    folds = spark.createDataFrame(
        [(0, 10, 50.0), (1, 10, 50.0)], sinks.RESULT_SCHEMAS["folds"]
    )
    sinks.write_tables({"folds": folds}, str(tmp_path))
    assert sinks.read_table(spark, str(tmp_path), "folds").collect() == folds.collect()
    nested = spark.createDataFrame([((1, None), {"a": 0.5})],
                                   "s struct<n:int,m:int>, scores map<string,double>")
    path = str(tmp_path / "doc")
    sinks.write_document(nested, path)
    files = list((tmp_path / "doc").glob("*.json"))
    assert json.loads(files[0].read_text()) == {"s": {"n": 1, "m": None}, "scores": {"a": 0.5}}
    back = sinks.read_document(spark, path).first()
    assert (back.s.n, back.scores.a) == (1, 0.5)


def test_kept_releases(spark):
    df = spark.range(3)
    with kept(df) as same:
        assert same is df and df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_insights_run_from_raw_text(spark):
    artists = readers.artists_daily(charts.daily_raw(spark, SF_DIR))
    albums = readers.albums_weekly(charts.weekly_raw(spark, SF_DIR))
    tables = run_insights(artists, albums, min_days=1, local_until=1, global_from=1, min_rows=1)
    assert len(tables) == 18
    assert all(df.count() > 0 for name, df in tables.items() if name != "market_anomalies")
