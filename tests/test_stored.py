"""Tables that are written once."""

from __future__ import annotations

import shutil
from types import SimpleNamespace

import pytest

from rankscope.sources import stored as st


def test_stored_rows_come_back_by_key(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k", "if(id % 5 = 0, null, 'x') as t")
    for keys in ((), ("k",), ("k", "t")):
        back = st.stored(df, keys)
        assert back.columns == df.columns and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        plan = back._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
    assert st.stored(df.limit(0), ("k",)).count() == 0


def session(master, folder=""):
    values = {"spark.master": master, st.SETTING: folder}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values.get(key, default)))


def test_folder_is_shared_or_the_session_is_local():
    assert st.shared_folder(session("spark://host:7077", "/shared/x/")) == "/shared/x"
    assert st.shared_folder(session("local[4]", "/y")) == "/y"
    assert st.shared_folder(session("local[4]")) == st.shared_folder(session("local"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            st.shared_folder(session(master))


def test_built_once_until_inputs_change_or_files_go(spark, tmp_path):
    source, calls = str(tmp_path / "in"), []
    spark.range(5).write.parquet(source)

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    def count(name="t"):
        return st.stored_once(spark, name, [source], build, ["id"]).count()

    assert [count(), count()] == [5, 5] and len(calls) == 1
    assert count("other settings") == 5 and len(calls) == 2
    spark.range(8).write.mode("overwrite").parquet(source)
    assert count() == 8 and len(calls) == 3
    folder = st._folders(st.stored_once(spark, "t", [source], build))[0].removeprefix("file://")
    shutil.rmtree(folder)
    assert count() == 8 and len(calls) == 4


def test_tables_of_one_build_stay_together(spark, tmp_path):
    source, calls = str(tmp_path / "in"), []
    spark.range(3).write.parquet(source)

    def build():
        calls.append(1)
        return {"a": spark.range(2), "b": spark.range(4)}

    for _ in range(2):
        made = st.tables_once(spark, "pair", [source], build)
        assert {name: df.count() for name, df in made.items()} == {"a": 2, "b": 4}
    assert len(calls) == 1
