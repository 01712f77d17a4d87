"""The coverage table is complete and names what exists."""

from __future__ import annotations

import importlib
import re
from pathlib import Path

from rankscope.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]
ROWS = {"S": 14, "P": 41, "J": 5, "A": 32, "W": 6, "O": 7, "U": 3, "X": 13, "Q": 22, "M": 23}
WANTED = [f"{letter}{i}" for letter, n in ROWS.items() for i in range(1, n + 1)]


def table():
    for line in (ROOT / "COVERAGE.md").read_text().splitlines():
        cells = [c.strip() for c in line.strip("|").split("|")]
        if len(cells) == 4 and re.fullmatch(r"[A-Z]\d+", cells[0]):
            yield cells[0], *[re.findall(r"`([^`]+)`", c) for c in cells[1:]]


def test_every_row_is_listed_and_exercised():
    rows = list(table())
    assert sorted(r[0] for r in rows) == sorted(WANTED)
    assert all(queries or tests for _, _, queries, tests in rows)


def test_names_exist():
    sources = "".join(p.read_text() for p in (ROOT / "tests").glob("test_*.py"))
    for _, _, queries, tests in table():
        assert set(queries) <= set(QUERIES)
        assert all(f"def {t}(" in sources for t in tests), tests


def test_places_exist():
    for row, places, _, _ in table():
        module = None
        for place in places:
            path, _, name = place.partition(".")
            if "/" in path or path == "session":
                module = importlib.import_module(f"rankscope.{path.replace('/', '.')}")
            elif name:
                module = importlib.import_module(f"rankscope.operators.{path}")
            else:
                name = path
            assert module is not None and (not name or hasattr(module, name)), (row, place)
