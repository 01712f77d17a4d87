"""Runs a registered query and its SQL twin on the same tables and reports the difference.

As a script: ``python tests/compare.py [sf_dir [name ...]]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from rankscope.plans.queries import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else "-0.0" if str(value) == "-0.0" else value
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = tuple(columns[i].lower() for i in order)
    return names, Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir, query, sql) -> str:
    """Empty if both give the same columns and rows."""
    df = query(spark, sf_dir)
    columns, rows = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    expected_columns, expected = as_rows([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} and {expected_columns}"
    missing, extra = expected - rows, rows - expected
    if missing or extra:
        return (
            f"rows {rows.total()} and {expected.total()}; only in SQL {list(missing)[:3]}, "
            f"only in Spark {list(extra)[:3]}"
        )
    return "" if rows else "no rows"


def main() -> None:
    import __spark_entry__ as entry
    from rankscope.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                outcome = difference(spark, con, sf_dir, queries[name], oracles[name]) or "equal"
            else:
                outcome = f"{len(queries[name](spark, sf_dir).collect())} rows, no SQL"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
