import ast
import pathlib

import pytest

from loomtext import catalog
from loomtext.operators import embed as E

ROOT = pathlib.Path(__file__).parent.parent


def test_core_does_not_import_the_subpackage():
    for p in (ROOT / "loomtext").rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_sql_belongs_to_queries():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith("lsa")])
def test_query_and_sql(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    df = catalog.queries()[name](spark, small)
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    con = duckdb.connect()
    for p in pathlib.Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    cols = [x[0] for x in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(repr(tuple(r[i] for i in order)) for r in cur.fetchall())
    assert sorted(cols) == sorted(df.columns)
    assert rows == want


def test_boilerplate_is_stripped_to_the_end(spark, tmp_path):
    spark.createDataFrame([(1, "文" * 1200 + "\n版权所有 某站\n尾")], "id long, raw_text string").write.parquet(f"{tmp_path}/site_documents.parquet")
    assert catalog.queries()["strip_boilerplate"](spark, str(tmp_path)).first()["text"] == "文" * 1200 + "\n尾"


def test_lsa_is_fitted_in_full(spark, small):
    model, rows = catalog._lsa(spark, small)
    terms = E.document_frequencies(rows, "chunk_text").count()
    assert len(model.vocabulary) == min(200_000, terms) and model.components.shape[1] == min(1024, rows.count() - 1, terms - 1)
    assert len(catalog.lsa_embed(spark, small).first()["embedding"]) == 1024


def test_lsa_search_reads_texts_once(spark, small, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    from loomtext.operators import search as Q

    fitted, real = [], E.fit_packed
    monkeypatch.setattr(E, "fit_packed", lambda *a, **k: fitted.append(real(*a, **k)) or fitted[-1])
    # the vectors come from the counts that the model was fitted on, and the matrix never leaves its folder
    monkeypatch.setattr(E.LsaModel, "embed", None)
    monkeypatch.setattr(E.LsaModel, "components", None)
    got = catalog.lsa_search(spark, small).collect()
    monkeypatch.undo()
    model = fitted[0][0]
    rows = spark.read.parquet(f"{small}/chunks.parquet").where("chunk_text IS NOT NULL")
    vector = model.embed_query(spark, "慢性肾结石的临床表现")
    want = Q.search_chunks(spark.read.parquet(f"{small}/site_documents.parquet"), rows.withColumn("embedding", model.embed(F.col("chunk_text"))), vector, 5).collect()
    assert len(got) == len(want) == 5
    assert np.allclose([r["similarity"] for r in got], [r["similarity"] for r in want], atol=2e-4)
    assert {r["text"] for r in got} == {r["text"] for r in want}


def test_recall_of_the_index(spark, small):
    pairs = lambda f: {(r["query_id"], r["vec_id"]) for r in f(spark, small).collect()}
    exact, near = pairs(catalog.topk_batched), pairs(catalog.topk_indexed)
    assert len(exact & near) >= 0.9 * len(exact)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_empty_and_null_tables(spark, bare, name):
    for folder in bare:
        catalog.queries()[name](spark, folder).collect()
