from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from kinweave.llm import plans

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("source1_entity_id", "string"), ("candidate_entity_id", "string")],
    "p3_found": [("entity_id_a", "string"), ("entity_id_b", "string")],
    "p5_found": [("entity_id_a", "string"), ("entity_id_b", "string")],
    "p6_found": [("source1_entity_id", "string"), ("candidate_entity_id", "string")],
    "p7_found": [("entity_id_a", "string"), ("entity_id_b", "string")],
    "p8_found": [("item_id", "bigint"), ("doc_id", "bigint")],
    "p10_found": [("doc_id", "bigint"), ("cell_no", "int"), ("para_no", "int"), ("lang", "string")],
}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def test_all_problems_have_a_query():
    assert {n.split("_")[0] for n in plans.queries()} >= {"p1", "p2", "p3", "p5", "p6", "p7", "p8", "p9", "p10"}
    assert set(plans.oracle_sql()) <= set(plans.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, name):
    df = plans.queries()[name](spark, DATA)
    assert df.dtypes == COLUMNS[name]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    if name in ("p3_found", "p5_found", "p7_found"):
        assert all(a < b for a, b in rows)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = plans.queries()[name](spark, DATA)
    want = con.execute(plans.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
