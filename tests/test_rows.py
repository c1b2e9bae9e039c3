import math

from pyspark.sql import functions as F

from loomtext.functions import vectors as V
from loomtext.operators import sample as S
from loomtext.operators import search as Q


def test_equidistant(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1), ("b", 2), (None, 5)], "g string, i int")
    got = sorted((r["g"] or "", r["i"]) for r in S.equidistant(df, 3, "g", ["i"]).collect())
    assert got == [("", 5), ("a", 0), ("a", 3), ("a", 6), ("b", 1), ("b", 2)]
    assert S.equidistant(df, 0, "g", ["i"]).count() == df.count()
    assert S.equidistant(df.where("false"), 3, "g", ["i"]).count() == 0


def test_equidistant_as_the_formula(spark):
    for n, cap in ((97, 13), (100, 7), (23, 22), (1000, 9)):
        df = spark.range(n).withColumn("g", F.lit("x"))
        want = [int(i * (n / cap)) for i in range(cap)]
        assert sorted(r["id"] for r in S.equidistant(df, cap, "g", ["id"]).collect()) == want


def test_positions_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    got = S.positions(df, "g", ["id"]).where("g = 'hot'").orderBy("id").select("_pos").collect()
    assert [r[0] for r in got] == list(range(len(got)))


def test_first_rows_new_rows_one_per_key(spark):
    df = spark.createDataFrame([("a", "u", 2), ("a", "u", 1), ("a", "v", 3), (None, "u", 4), (None, "u", 5)], "s string, u string, i int")
    assert sorted(r["i"] for r in S.first_rows(df, 1, "s", ["i"]).collect()) == [1, 4]
    assert sorted(r["i"] for r in S.one_per_key(df, ["s", "u"], ["i"]).collect()) == [1, 3, 4]
    assert S.one_per_key(df, ["s", "u"], ["i"]).columns == df.columns
    stored = spark.createDataFrame([("a", "u"), (None, "u")], "s string, u string")
    assert sorted(r["i"] for r in S.new_rows(df, stored, ["s", "u"]).collect()) == [3, 4, 5]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([3.0, 4.0, 12.0],), (None,), ([],)], "v array<double>")
    v = F.col("v")
    assert [r[0] for r in df.select(V.l2_norm(v)).collect()] == [5.0, 0.0, 13.0, None, 0.0]
    assert [r[0] for r in df.select(V.fit_width(v, 3)).collect()] == [[3, 4, 0], [0, 0, 0], [3, 4, 12], None, [0, 0, 0]]
    assert df.select(V.fit_width(v, 1)).first()[0] == [3.0]
    got = [r[0] for r in df.select(V.l2_normalize(v)).collect()]
    assert all(math.isclose(a, b) for a, b in zip(got[0], [0.6, 0.8])) and got[1] == [0.0, 0.0]
    assert [r[0] for r in df.select(V.cosine_to(v, [3.0, 4.0])).collect()][:2] == [1.0, 0.0]
    assert [r[0] for r in df.select(V.cosine_to(v, [0.0, 0.0])).collect()] == [0.0, 0.0, 0.0, None, 0.0]


def rows(spark, n=300):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(n, 8))
    return x, spark.createDataFrame([(i, x[i].tolist()) for i in range(n)] + [(n, None), (n + 1, [0.0] * 8)], "id long, embedding array<double>")


def test_top_k_batch_is_exact(spark):
    import numpy as np

    x, df = rows(spark)
    q = df.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding")
    got = Q.top_k_batch(q, df, 4, 8, block=2).orderBy("query_id", "rank").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in (0, 100, 200):
        want = np.argsort(-(u @ u[i]))[:4].tolist()
        assert [r["id"] for r in got if r["query_id"] == i] == want
    assert Q.top_k_batch(q.where("false"), df, 4, 8).count() == 0
    assert Q.top_k_batch(q, df.where("false"), 4, 8).count() == 0


def test_cell_index_recall(spark):
    _, df = rows(spark)
    q = df.where("id % 10 = 0").select(F.col("id").alias("query_id"), "embedding")
    exact = {(r["query_id"], r["id"]) for r in Q.top_k_batch(q, df, 5, 8).collect()}
    index = Q.CellIndex.build(df, 8)
    assert index.rows.count() == 301  # every row with a vector
    near = {(r["query_id"], r["id"]) for r in index.search(q, 5, len(index.centres) * 2 // 3).collect()}
    full = {(r["query_id"], r["id"]) for r in index.search(q, 5, len(index.centres)).collect()}
    assert len(exact & near) >= 0.9 * len(exact) and len(exact & full) >= len(exact) - 5  # ties of the zero vector apart
    assert Q.CellIndex.build(df.where("false"), 8).search(q, 5, 3).count() == 0


def test_search_chunks(spark):
    docs = spark.createDataFrame([(1, "a", "u1", "t1"), (2, "b", "u2", None)], "id long, source string, source_url string, title string")
    c = spark.createDataFrame(
        [(1, 0, "x", [1.0, 0.0]), (1, 1, "y", [0.0, 1.0]), (2, 0, "z", [1.0, 0.0]), (2, 1, "n", None), (9, 0, "orphan", [1.0, 0.0])],
        "document_id long, chunk_index int, chunk_text string, embedding array<double>",
    )
    hit = lambda *a: [(r["source"], r["text"], r["similarity"]) for r in Q.search_chunks(docs, c, [2.0, 0.0], *a).collect()]
    assert hit(2) == [("a", "x", 1.0), ("b", "z", 1.0)] == hit(2, [])
    assert hit(50, ["b"]) == [("b", "z", 1.0)]
    assert len(hit(50)) == 3 and hit(5, ["none"]) == []
    assert [r["similarity"] for r in Q.search_chunks(docs, c, [0.0, 0.0], 2).collect()] == [0.0, 0.0]
