import pathlib

import pytest

from loomtext.llm import queries

COLUMNS = {
    "p1_found": ["tab", "id_a", "id_b"],
    "p2_found": ["tab", "rec_id", "line_no"],
    "p3_found": ["tab", "rec_id"],
    "p4_found": ["id", "line_no"],
    "p5_found": ["id_a", "id_b"],
    "p6_found": ["tab", "rec_id"],
    "p7_found": ["tab", "id_a", "id_b"],
    "p8_ids": ["doc_id", "ids"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, small, name):
    df = queries.queries()[name](spark, small)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        if name != "p8_ids":
            assert len(set(rows)) == len(rows)
    sql = queries.oracle_sql().get(name)
    if sql:
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for p in pathlib.Path(small).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        cur = con.execute(sql)
        assert [x[0] for x in cur.description] == df.columns
        assert sorted(map(repr, cur.fetchall())) == sorted(map(repr, rows))


def test_every_problem_has_queries():
    assert {n.split("_")[0] for n in queries.queries()} == {f"p{i}" for i in range(1, 11)}
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_and_null_tables(spark, bare, name):
    for folder in bare:
        rows = queries.queries()[name](spark, folder).collect()
        assert not rows or not name.endswith("_found")
