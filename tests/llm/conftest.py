from __future__ import annotations

import os
from pathlib import Path

import pytest
from tables import TINY

REPO = Path(__file__).resolve().parents[2]
# workers of a local session import the package by this path
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (str(REPO), os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def tiny_docs(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet").toPandas()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, repeats, and extra columns with names that operators use."""
    long = "wordy " * 30_000 + "x" * 5_000
    rows = [
        (1, None, None, None, 0, "a"), (2, "", "en", "src0", 1, None), (3, long, "en", "src1", 2, "b"),
        (4, "the same text of six words", "en", None, 3, "c"), (4, "the same text of six words", "en", None, 3, "c"),
        (5, "the same text of six words", None, "src2", 3, "c"), (None, "a text without id", "de", "src3", None, "d"),
        (6, "  \n\t ", "fr", "src0", 4, "e"), (7, "12 34 !!", "fr", "src0", 5, "f"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, row long, shard string"
    )
