from __future__ import annotations

import ast
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from kinweave.plans import registry

DATA = os.environ.get("KINWEAVE_TESTDATA", "/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parent.parent


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    for f in (ROOT / "kinweave").rglob("*.py"):
        if "llm" in f.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), f


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    flat = lambda v: f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(flat(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = registry.queries()[name](spark, DATA)
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(want.fetchall(), names)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
